"""Document fingerprints from closed syncmers, with DataFrame functions only.

A text is a sequence of tokens: its words, those above 16 characters cut from the left. A k-mer of tokens
is a closed syncmer if the smallest hash of its inner s-mers belongs to the first or the last one.
That depends on the k-mer alone, so a text part gives the same anchors wherever it stands, and
every window of ``2k - s`` tokens holds an anchor.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearfield.operators.ordinals import join_sized, with_ordinal
from nearfield.session import cut_lineage

TOKEN = r"[^\x20\x09-\x0D]{1,16}"
K, S = 6, 2
BLOCK = 256  # documents that are neighbours in key order and handled by one task


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """``array<struct<pos, hash>>``: the closed syncmers of a text in order; ``pos`` is a token's number.

    ``hash`` has 32 bits. A text of fewer than ``k`` tokens has no k-mer and gets one anchor, of the
    whole text, at 0. Null counts as empty.
    """
    last = k - s
    if s < 1 or last < 1:
        raise ValueError("0 < s < k")

    def pick(m: Column) -> Column:
        def closed(i: Column) -> Column:
            inner = [m[i + j] for j in range(1, last)]
            edges = F.least(m[i], m[i + last])
            return edges <= (F.least(*inner) if len(inner) > 1 else inner[0]) if inner else F.lit(True)

        # s-mers a step of s apart, and the last one, spell the whole k-mer
        spelled = sorted({*range(0, last + 1, s), last})
        places = F.filter(F.sequence(F.lit(0), F.size(m) - last - 1), closed)
        return F.transform(
            places,
            lambda i: F.struct(i.alias("pos"), F.xxhash64(*[m[i + j] for j in spelled]).bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash")),
        )

    def mers(h: Column) -> Column:
        n = F.size(h) - (s - 1)
        parts = [F.slice(h, j + 1, n) for j in range(s)]
        return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y)), parts)

    text = F.coalesce(text, F.lit(""))
    whole = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash")))
    hashes = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))
    return _let(
        hashes, lambda h: F.when(F.size(h) < k, whole).otherwise(_let(mers(h), pick))
    )


def anchor_set(text: Column, k: int = K, s: int = S) -> Column:
    """Distinct anchor hashes in order of first occurrence."""
    return F.array_distinct(F.transform(anchors(text, k, s), lambda a: a["hash"]))


def fingerprint(hashes: Column) -> Column:
    """Anchor hashes as text, eight hex digits each."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Shared anchors over those of the larger set, 0 to 1; 1 for equal fingerprints."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b), F.lit(1))


def matches(a: Column, b: Column) -> Column:
    """Positional matching: ``array<struct<pos, other>>``, anchors of ``a`` with the place of each in ``b``.

    Of anchors that ``b`` holds more than once the first place counts.
    """

    def place(known: Column) -> Column:
        return F.filter(
            F.transform(a, lambda x: F.struct(x["pos"].alias("pos"), (F.array_position(known["hashes"], x["hash"])).alias("at"))),
            lambda m: m["at"] > 0,
        )

    known = F.struct(F.transform(b, lambda x: x["hash"]).alias("hashes"), F.transform(b, lambda x: x["pos"]).alias("places"))
    return _let(
        known,
        lambda t: F.transform(place(t), lambda m: F.struct(m["pos"], F.element_at(t["places"], m["at"].cast("int")).alias("other"))),
    )


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, text, next_text)``: the text of the next document by descending key, at the end the first.

    Rows of one key and text count as one document; those of one key with other texts follow each other by hash. Null keys
    come last, null texts count as empty. Keys alone are sorted; texts move in blocks of neighbours, and a block's first text
    also goes to the block before. Where the order is too long to be broadcast, its join moves the texts once more.
    """
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t"))
    ids = with_ordinal(rows.select("k", "h").distinct(), [F.col("k").desc_nulls_last(), F.col("h")], "ord")
    ids = cut_lineage(ids, "order")
    count = ids.count()
    placed = join_sized(rows, ids, ["k", "h"])
    block = F.floor(F.col("ord") / BLOCK).cast("long")
    own = F.struct(block.alias("block"), F.col("ord").alias("place"), F.lit(False).alias("guest"))
    place = F.when(F.col("ord") == 0, F.lit(count)).otherwise(F.col("ord")).cast("long")
    guest = F.struct(F.floor((place - 1) / BLOCK).cast("long").alias("block"), place.alias("place"), F.lit(True).alias("guest"))
    homes = F.when(F.col("ord") % BLOCK == 0, F.array(own, guest)).otherwise(F.array(own))
    dealt = placed.select("k", "t", F.explode(homes).alias("x")).select("k", "t", "x.*")
    after = Window.partitionBy("block").orderBy("place").rangeBetween(1, 1)
    return dealt.withColumn("next_text", F.first("t").over(after)).where("NOT guest").select(
        F.col("k").alias(key), F.col("t").alias(text), "next_text"
    )


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every row's whole text and of its edited text, and how alike they are.

    The edited text has its last ``floor(n / 2)`` code points replaced by the first as many of the next
    document (see ``with_next``). Returns ``key, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``; equal texts have equal fingerprints.
    """
    rows = with_next(docs, key, text).withColumn("n_chars", F.length(text).cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(text, 1, F.col("n_chars").cast("int") - half), F.substring("next_text", 1, half))
    rows = rows.withColumn("edited", edited)
    rows = rows.select(
        key,
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array(*[anchor_set(F.col(c), k, s) for c in (text, "edited", "next_text")]).alias("sets"),
    )
    own, changed, after = (F.col("sets")[i] for i in range(3))
    return rows.select(
        key,
        "n_chars",
        "edited_sha256",
        fingerprint(own).alias("fingerprint"),
        fingerprint(changed).alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"),
        likeness(own, after).alias("near_next"),
    )
