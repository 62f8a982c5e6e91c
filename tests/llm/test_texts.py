"""Operators on texts against brute force, on rows of every odd kind."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from nearfield.llm import kneserney, substring, words
from nearfield.llm.components import connected_components
from nearfield.llm.idcoder import decode_blocks, encode_blocks
from nearfield.llm.kneserney import fit_bigrams, score_texts
from nearfield.llm.langid import fit_languages, identify_languages, keep_identified
from nearfield.llm.packing import Limits, pack, pack_documents
from nearfield.llm.simhash import simhash_dedup, simhash_groups, simhash_links
from nearfield.llm.substring import level_lengths, remove_repeats, substring_digest
from nearfield.llm.syncmers import anchors, fingerprint_edits, matches
from nearfield.llm.tokenfile import read_token_file, read_token_files, write_token_files
from nearfield.llm.tokens import TokenEncoder, default_tokenizer
from odd_rows import documents, empty  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def given(documents):
    return [(r.doc_id, r.text) for r in documents.collect()]


def unsigned_crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


# --- op 1 and 3 ---------------------------------------------------------------------------

def test_pieces_encode_like_whole_texts(tokenizer):
    import random

    r = random.Random(5)
    letters = "ab '\n\t  éß1,.! 　\x1c\x85日<|endoftext|>"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(800)]
    texts += ["", " ", "\n \n", "x" * 300 + " <|endoftext|> a  b\n\n c", "don't  stop"]
    encoder = TokenEncoder(default_tokenizer())
    for _ in range(2):  # the second time from the store
        ids, offsets = encoder.encode(texts, 7)
        for i, text in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [7]


@pytest.mark.parametrize("nibbles", [4, 7])
def test_blocks_round_trip(rng, nibbles):
    blocks = [rng.integers(0, 50_257, n).astype(np.uint32) for n in (1, 5, 700, 64)]
    blocks += [np.zeros(900, np.uint32), np.tile(np.arange(50, dtype=np.uint32), 20), np.full(3, 65_535, np.uint32)]
    if nibbles == 7:
        blocks.append(np.array([2**28 - 1, 0, 2**28 - 1], dtype=np.uint32))
    payloads = encode_blocks(blocks, nibbles)
    found = decode_blocks(payloads, [len(b) for b in blocks], nibbles)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, found))
    alone = decode_blocks([payloads[2]], [700], nibbles)  # blocks do not depend on each other
    assert np.array_equal(alone[0], blocks[2])
    assert len(payloads[5]) < 4000 / 20


def test_token_files(documents, empty, tokenizer, tmp_path):
    files = write_token_files(documents, f"file://{tmp_path}/ids", file_ids=500)
    found = rows(read_token_files(files), "doc_id", "start", "n_tokens", "ids_crc32")
    expected, start = [], 0
    keyed = [(k is not None, k or 0, t or "") for k, t in given(documents)]
    for has, k, t in sorted(keyed, key=lambda x: x[:2]):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [0]
        expected.append((k if has else None, start, len(ids), unsigned_crc(ids)))
        start += len(ids)
    assert found == sorted(expected, key=repr)
    listed = files.collect()
    assert len(listed) > 1
    empty_files = write_token_files(empty, f"file://{tmp_path}/none")
    assert read_token_files(empty_files).count() == 0

    path = listed[0].path.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[6] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(ValueError, match="damaged"):
        list(read_token_file(f"file://{path}"))


def check_packing(pieces, texts, tokenizer, most=2048):
    per_doc, per_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        per_doc[p.doc_id].append(p)
        per_sequence[p.sequence_id].append(p)
    whole = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for k, t in texts}
    copies = Counter(k for k, _ in texts)
    for k, found in per_doc.items():
        assert {p.doc_tokens for p in found} == {len(whole[k])}
        assert sum(p.length for p in found) == copies[k] * len(whole[k])
        cover = np.zeros(len(whole[k]), dtype=int)
        for p in found:
            cover[p.start : p.start + p.length] += 1
            assert p.ids_crc32 == unsigned_crc(whole[k][p.start : p.start + p.length])
        assert (cover == copies[k]).all()
    padding = 0
    for found in per_sequence.values():
        place = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == place
            place += p.length
        assert 0 < place <= most
        padding += 0 if place & (place - 1) == 0 else most - place
    assert set(per_doc) == {k for k, _ in texts}
    return padding


def test_packing(documents, empty, tokenizer):
    assert check_packing(pack_documents(documents).collect(), given(documents), tokenizer) == 0
    assert pack_documents(empty).count() == 0


def test_packing_keeps_all_limits(rng):
    tokens = rng.integers(1, 900, 400)
    loss = (tokens * rng.random(400)).astype(np.int64)
    limits = Limits(1024, 6, 400)
    sequences = pack(tokens, loss, limits)
    assert sum(p[2] for s in sequences for p in s) == tokens.sum()
    for s in sequences:
        assert sum(p[2] for p in s) <= 1024 and len(s) <= 6
        assert sum(max(0, a + n - max(a, tokens[d] - loss[d])) for d, a, n in s) <= 400


def test_short_rows_need_no_padding(spark, tokenizer):
    """The segment limit closes every sequence here, below its token limit."""
    lengths = [[p[2] for p in s] for s in pack(np.full(20_000, 5), np.full(20_000, 5), Limits())]
    assert sum(map(sum, lengths)) == 100_000 and all(len(s) <= 256 for s in lengths)
    assert all(sum(s) & (sum(s) - 1) == 0 for s in lengths)
    texts = [(i, "Yes. No.") for i in range(2000)]
    found = pack_documents(spark.createDataFrame(texts, "doc_id long, text string").coalesce(2)).collect()
    assert check_packing(found, texts, tokenizer) == 0


def test_scarce_segments_and_loss(rng):
    """Loss and segments both bind; what they close early is cut, nothing is lost, and all limits hold."""
    tokens = rng.integers(1, 60, 3000)
    loss = np.where(rng.random(3000) < 0.7, tokens, tokens // 3)
    limits = Limits(1024, 20, 300)
    sequences = pack(tokens, loss, limits)
    cover = Counter()
    for s in sequences:
        total = sum(p[2] for p in s)
        assert total == 1024 or total & (total - 1) == 0
        assert len(s) <= 20 and sum(max(0, a + n - max(a, tokens[d] - loss[d])) for d, a, n in s) <= 300
        cover.update((d, i) for d, a, n in s for i in range(a, a + n))
    assert len(cover) == tokens.sum() and set(cover.values()) == {1}
    for bad in ({"loss_tokens": 0}, {"segments": 0}, {"tokens": 0}):
        with pytest.raises(ValueError):
            Limits(**bad)


def test_ids_wider_than_the_file(documents, tmp_path):
    with pytest.raises(ValueError, match="do not fit 8"):
        write_token_files(documents, f"file://{tmp_path}/a", id_bits=8)
    files = write_token_files(documents, f"file://{tmp_path}/b", end_id=70_000)
    assert all(r.ids[-1] == 70_000 for r in read_token_files(files, with_ids=True).collect())


# --- op 2 ---------------------------------------------------------------------------------

def brute_substring(texts, n=13):
    starts = defaultdict(set)
    for k, t in texts:
        w = SPLIT.findall(t or "")
        for i in range(len(w) - n + 1):
            if k is not None:
                starts[tuple(w[i : i + n])].add(k)
    out = []
    for k, t in texts:
        w = SPLIT.findall(t or "")
        gone = set()
        for i in range(len(w) - n + 1):
            if k is not None and min(starts[tuple(w[i : i + n])]) < k:
                gone.update(range(i, i + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [13, 4])
def test_substring(documents, empty, window):
    found = rows(substring_digest(documents, window=window), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == brute_substring(given(documents), window)
    assert substring_digest(empty).count() == 0
    cut = remove_repeats(documents)
    assert cut.columns == documents.columns
    texts = {r.id: r.text for r in cut.collect()}
    assert "k1" not in texts and texts["none"] and texts["k4"] == ""  # emptied by removal; no key; empty before


def test_slices_without_repeats(documents, monkeypatch):
    """A slice in which no text loses a word has the same columns as the others."""
    whole = sorted(map(repr, remove_repeats(documents).collect()))
    monkeypatch.setattr(words, "SLICE_BYTES", 100)
    assert sorted(map(repr, remove_repeats(documents).collect())) == whole


def test_long_windows(spark, monkeypatch):
    """A window of 200 words takes six levels; passages that repeat at shorter lengths only stay, and end the search."""
    import random

    r = random.Random(5)

    def made(n):
        return [f"w{r.randrange(3000)}" for _ in range(n)]

    assert level_lengths(13) == [7, 13] and level_lengths(200) == [7, 13, 25, 50, 100, 200] and level_lengths(1) == [1, 1]
    long, mid, short = made(260), made(150), made(20)
    texts = [
        (i, " ".join(made(r.randrange(80)) + (long if i % 3 == 0 else mid if i % 3 == 1 else short) + made(r.randrange(80)) + long * (i == 7)))
        for i in range(12)
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = rows(substring_digest(df, window=200), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == brute_substring(texts, 200) and sum(f[2] for f in found) >= 4 * 260
    calls = []
    real = substring._extension
    monkeypatch.setattr(substring, "_extension", lambda a, b, first: calls.append(b) or real(a, b, first))
    rest = df.where("doc_id % 3 = 1 AND doc_id != 7")
    assert {r.n_removed for r in substring_digest(rest, window=200).collect()} == {0}
    assert calls == [13, 25, 50, 100, 200]
    calls.clear()
    alone = df.where("doc_id IN (0, 1, 2)")
    assert {r.n_removed for r in substring_digest(alone, window=200).collect()} == {0} and calls == []


# --- op 5 ---------------------------------------------------------------------------------

def test_fingerprints(documents, empty):
    found = fingerprint_edits(documents).collect()
    assert len(found) == 14
    texts = sorted({(k is not None, k or 0, t or "") for k, t in given(documents)}, key=lambda x: x[:2], reverse=True)
    expected = Counter()
    copies = Counter((k, t or "") for k, t in given(documents))
    for i, (has, k, t) in enumerate(texts):
        after, h = texts[(i + 1) % len(texts)][2], len(t) // 2
        edited = t[: len(t) - h] + after[:h]
        expected[(k if has else None, len(t), hashlib.sha256(edited.encode()).hexdigest())] = copies[(k if has else None, t)]
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == expected
    by_id = {r.doc_id: r for r in found}
    assert by_id[0].fingerprint == by_id[1].fingerprint == by_id[None].fingerprint
    assert all(0 <= x <= 1 for r in found for x in (r.near_edited, r.near_next))
    assert 0.3 < by_id[7].near_edited < 0.7 and by_id[7].near_next < 0.1
    assert by_id[1].near_next == 1.0  # the next document is its copy
    assert fingerprint_edits(empty).count() == 0


def test_anchors_do_not_depend_on_context(spark):
    common = " ".join(f"w{i}" for i in range(200))
    a, b = f"p q r {common} s", f"{common} other end"
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        anchors(F.col("a")).alias("x"), anchors(F.col("b")).alias("y"), matches(anchors(F.col("a")), anchors(F.col("b"))).alias("m")
    ).first()
    assert len(row.m) >= 0.9 * min(len(row.x), len(row.y)) and {m.pos - m.other for m in row.m} == {3}
    gaps = np.diff([x.pos for x in row.x])
    assert gaps.max() <= 2 * 6 - 2 and len(row.x) < 0.6 * 200


def plain_anchors(text, k=6, s=2):
    """Closed syncmers word by word, with the hash the functions use: XXH64, columns chained through the seed."""

    def signed(h):
        return h - 2**64 if h >= 2**63 else h

    def chained(*values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), seed)
        return signed(seed)

    tokens = [signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in re.findall(r"[^\x20\x09-\x0D]{1,16}", text)]
    if len(tokens) < k:
        return [xxhash.xxh64_intdigest(text.encode(), 42) & 0xFFFFFFFF]
    mers = [chained(*tokens[i : i + s]) for i in range(len(tokens) - s + 1)]
    out = []
    for i in range(len(tokens) - k + 1):
        inner = mers[i : i + k - s + 1]
        if min(inner[0], inner[-1]) == min(inner):
            out.append(chained(inner[0], inner[2], inner[4]) & 0xFFFFFFFF)
    return out


def test_fingerprints_against_plain_syncmers(spark):
    import random

    r = random.Random(8)
    texts = {i: " ".join(r.choice(["a", "bb", "c", "ééé", "日本語", "x" * 40]) + r.choice(["", str(r.randrange(4))]) for _ in range(n))
             for i, n in enumerate([0, 1, 5, 6, 7, 60, 200, 61, 400, 3])}
    texts[20], texts[21] = None, texts[6] + "\n" + texts[8]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    order = sorted(texts, reverse=True)
    found = {x.doc_id: x for x in fingerprint_edits(df).collect()}
    for here, there in zip(order, order[1:] + order[:1]):
        own, other = texts[here] or "", texts[there] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + other[:half]
        sets = [list(dict.fromkeys(plain_anchors(t))) for t in (own, edited, other)]
        got = found[here]
        assert got.fingerprint == "".join(f"{h:08x}" for h in sets[0])
        assert got.edited_fingerprint == "".join(f"{h:08x}" for h in sets[1])
        for likeness, after in ((got.near_edited, sets[1]), (got.near_next, sets[2])):
            assert likeness == len(set(sets[0]) & set(after)) / max(len(sets[0]), len(after), 1)


# --- op 6 ---------------------------------------------------------------------------------

def test_languages(spark, empty, documents):
    r = np.random.default_rng(2)
    made = {"aa": ["kato", "miru", "senda", "tolo"], "bb": ["schrift", "zwang", "knecht", "pfad"]}
    data = [(i, " ".join(r.choice(made[l], 30)), l) for i, l in enumerate(["aa", "bb"] * 40)]
    docs = spark.createDataFrame([*data, (900, "12 !?", None), (901, None, "aa"), (902, "", "bb")], "doc_id long, text string, lang string")
    model = fit_languages(docs.where("doc_id < 60"))
    found = {x.doc_id: x for x in identify_languages(docs, model).collect()}
    assert all(found[i].lang_pred == l and found[i].score > 0.9 for i, _, l in data)
    assert all((found[i].lang_pred, found[i].score) == ("und", 0.0) for i in (900, 901, 902))
    named = docs.withColumn("score", F.lit(7)).withColumn("lang_pred", F.lit("x")).withColumn("_letters", F.lit(1))
    kept = keep_identified(named, model)  # names the operator uses itself
    assert kept.columns == named.columns and kept.count() == 80 and kept.first().score == 7
    assert fit_languages(empty).languages == []
    assert {x.lang_pred for x in identify_languages(documents, fit_languages(empty)).collect()} == {"und"}
    assert identify_languages(empty, model).count() == 0


def test_languages_against_plain_em(spark):
    """Two rounds of plain expectation-maximisation over all segmentations, then the likeliest language."""
    import sentencepiece

    from nearfield.llm.langid import WORD_BYTES, default_vocabulary

    tool = sentencepiece.SentencePieceProcessor(model_file=default_vocabulary())
    known = {bytes([b]) for b in range(256)} | {
        tool.id_to_piece(i).replace("▁", " ").encode() for i in range(tool.get_piece_size())
        if not (tool.is_control(i) or tool.is_unknown(i) or tool.is_byte(i) or tool.is_unused(i))
    }
    number = {x: i for i, x in enumerate(sorted(x for x in known if len(x) <= WORD_BYTES))}
    r = np.random.default_rng(3)
    made = {"x": ["der", "hund", "läuft", "schnell"], "y": ["the", "dog", "runs", "fast"], "z": ["le", "chien", "court", "vite"]}
    data = [(i, " ".join(r.choice(made[l] + made["y"][:2], 12)), l) for i, l in enumerate("xyz" * 10)]
    data += [(100, "Der the", None), (101, "ünbekannt Wort le le", None), (102, "a", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")

    def cuts(word):
        text = b" " + word
        return text, [(a, b, number[text[a:b]]) for a in range(len(text)) for b in range(a + 1, len(text) + 1) if text[a:b] in number]

    def forward(word, p):
        text, edges = cuts(word)
        ways = [1.0] + [0.0] * len(text)
        for a, b, piece in sorted(edges):
            ways[b] += ways[a] * p[piece]
        return ways, edges

    def words(text):
        return [w.encode() for w in SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))]

    models = {}
    for l in "xyz":
        p = [1 / len(number)] * len(number)
        for _ in range(2):
            uses = [0.02] * len(number)
            for _, text, own in data:
                for word in words(text) if own == l else []:
                    ways, edges = forward(word, p)
                    back = [0.0] * len(ways)
                    back[-1] = 1.0
                    for a, b, piece in sorted(edges, reverse=True):
                        back[a] += p[piece] * back[b]
                    for a, b, piece in edges:
                        uses[piece] += ways[a] * p[piece] * back[b] / ways[-1]
            p = [u / sum(uses) for u in uses]
        models[l] = p
    model = fit_languages(docs)
    assert model.languages == ["x", "y", "z"]
    np.testing.assert_allclose(model.log_p, np.log(np.array([models[l] for l in "xyz"]).T), atol=1e-7)
    for found in identify_languages(docs, model).collect():
        text = data[[d[0] for d in data].index(found.doc_id)][1]
        logs = [sum(math.log(forward(w, models[l])[0][-1]) for w in words(text)) for l in "xyz"]
        assert found.lang_pred == "xyz"[int(np.argmax(logs))]
        assert abs(found.score - 1 / sum(math.exp(x - max(logs)) for x in logs)) < 1e-5


def test_forward_sums_all_segmentations():
    from nearfield.llm.langid import Pieces, default_vocabulary, word_scores

    pieces = Pieces(default_vocabulary())
    log_p = np.full((pieces.n, 1), -2.0)
    word = b"these"
    data = np.frombuffer(word, dtype=np.uint8)
    got = word_scores(pieces, log_p, data, np.array([0]), np.array([5]))[0, 0]
    text = b" " + word
    ways = [1.0] + [0.0] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            padded = np.zeros((1, end - start), dtype=np.uint8)
            padded[0] = np.frombuffer(text[start:end], dtype=np.uint8)
            if pieces.lattice(padded)[0, end - start - 1, 0] < pieces.n:
                ways[end] += ways[start] * math.exp(-2.0)
    assert abs(got - math.log(ways[-1])) < 1e-9


# --- op 8 ---------------------------------------------------------------------------------

def test_kneser_ney(documents, empty):
    texts = given(documents)
    tokens = {t: [w.encode() for w in SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] + ["end"] for _, t in texts}
    train = [tokens[t] for k, t in texts if k is not None and k != 7]
    uni = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["begin", *t], t))
    lefts = Counter(w for _, w in pairs)
    total, size = sum(uni.values()), len(uni)

    def discounts(counts):
        return kneserney._discounts(*(sum(1 for c in counts if c == k) for k in (1, 2, 3, 4)))

    high, low = discounts(pairs.values()), discounts(lefts.values())

    def cut(c, d):
        return d[min(c, 3) - 1] if c else 0.0

    spare = sum(cut(c, low) for c in lefts.values()) / len(pairs)
    mass, rest = Counter(), defaultdict(float)
    for (u, _), c in pairs.items():
        mass[u] += c
        rest[u] += cut(c, high)

    def p(u, w):
        one = (lefts[w] - cut(lefts[w], low)) / len(pairs) + spare / (size + 1)
        return one if not mass[u] else (pairs[u, w] - cut(pairs[u, w], high) + rest[u] * one) / mass[u]

    expected = sorted(
        (
            (
                k, len(tokens[t]), sum(uni[w] > 0 for w in tokens[t]), total,
                round(sum(math.log10((uni[w] + 1) / (total + size + 1)) for w in tokens[t]), 6),
                round(sum(math.log10(p(u, w)) for u, w in zip(["begin", *tokens[t]], tokens[t])), 6),
            )
            for k, t in texts
        ),
        key=repr,
    )
    for shard_tokens in (10_000_000, 300):
        model = fit_bigrams(documents.where("doc_id IS NOT NULL AND doc_id != 7"), shard_tokens=shard_tokens)
        scored = score_texts(documents, model).withColumns({c: F.round(c, 6) for c in ("base_score", "score")})
        assert rows(scored, "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score") == expected
    assert score_texts(empty, model).count() == 0
    untrained = score_texts(documents, fit_bigrams(empty)).collect()
    assert {(r.train_tokens, r.n_known, r.score) for r in untrained} == {(0, 0, 0.0)}


def test_kneser_ney_of_order_three(documents, empty):
    from nearfield.llm.kneserney import fit_ngrams

    texts = given(documents)
    tokens = {t: [w.encode() for w in SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] + ["end"] for _, t in texts}
    train = [tokens[t] for k, t in texts if k is not None and k != 7]
    uni = Counter(w for t in train for w in t)
    triples = Counter(x for t in train for x in zip(["begin", *t], t, t[1:]))
    pairs = Counter((v, w) for _, v, w in triples) + Counter(("begin", t[0]) for t in train)
    lefts = Counter(w for _, w in pairs)

    def level(grams):
        d = kneserney._discounts(*(sum(1 for c in grams.values() if c == k) for k in (1, 2, 3, 4)))
        mass, rest = Counter(), defaultdict(float)
        for g, c in grams.items():
            mass[g[:-1]] += c
            rest[g[:-1]] += d[min(c, 3) - 1]
        return lambda g, p: p if not mass[g[:-1]] else (grams[g] - (d[min(grams[g], 3) - 1] if grams[g] else 0) + rest[g[:-1]] * p) / mass[g[:-1]]

    one, two, three = (level(x) for x in (Counter({(w,): c for w, c in lefts.items()}), pairs, triples))

    def p(t, i):
        best = two((["begin", *t][i], t[i]), one((t[i],), 1 / (len(uni) + 1)))
        return three((["begin", *t][i - 1], t[i - 1], t[i]), best) if i else best

    expected = sorted(((k, round(sum(math.log10(p(tokens[t], i)) for i in range(len(tokens[t]))), 6)) for k, t in texts), key=repr)
    for shard_tokens in (10_000_000, 300, 20):
        model = fit_ngrams(documents.where("doc_id IS NOT NULL AND doc_id != 7"), order=3, shard_tokens=shard_tokens)
        assert rows(score_texts(documents, model).withColumn("score", F.round("score", 6)), "doc_id", "score") == expected
    assert {r.score for r in score_texts(documents, fit_ngrams(empty)).collect()} == {0.0}


# --- op 10 --------------------------------------------------------------------------------

def simhash(text):
    w = [x.encode() for x in SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups(prints, distance=2):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def test_simhash(documents, empty):
    texts = given(documents)
    prints = [simhash(t) for _, t in texts]
    of = groups(prints)
    least = defaultdict(list)
    for (k, _), g in zip(texts, of):
        least[g] += [k] * (k is not None)
    expected = sorted(((k, f"{f:016x}", min(least[g], default=None)) for (k, _), f, g in zip(texts, prints, of)), key=repr)
    assert rows(simhash_groups(documents), "doc_id", "fingerprint", "component_id") == expected
    assert simhash_groups(empty).count() == 0
    kept = simhash_dedup(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({e[2] for e in expected if e[2] is not None})


@pytest.mark.parametrize("distance", [1, 2])
@pytest.mark.parametrize("pair_group", [64, 1])
def test_simhash_links_lose_nothing(spark, rng, distance, pair_group):
    """Chains and dense groups around random centres, with all groups joined or all met half way."""
    prints = set()
    for centre in rng.integers(0, 2**63, 12).tolist():
        for _ in range(40):
            f = centre
            for bit in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                f ^= 1 << bit
            prints.add(f)
    prints = sorted(prints)
    signed = [f - 2**64 if f >= 2**63 else f for f in prints]
    links = simhash_links(spark.createDataFrame([(f,) for f in signed], "fp long"), distance, pair_group)
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= distance for r in links.collect())
    parts = {r.id: r.component for r in connected_components(links).collect()}
    of = groups(prints, distance)
    for i, f in enumerate(signed):
        members = [signed[j] for j, g in enumerate(of) if g == of[i]]
        assert parts.get(f, f) == min(members)


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5), (200, 200)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long").repartition(7)).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- near copies of the pipeline ----------------------------------------------------------

def test_pipeline_drops_near_copies(spark, documents, empty, tmp_path):
    """Copies with few changed words: the stage keeps what the contract's shingles and distance keep, by all pairs."""
    import random

    import corpus_pipeline

    r = random.Random(11)
    texts = []
    for _ in range(12):
        words = [f"{r.choice('abcdef')}{r.randrange(4000)}" for _ in range(300)]
        for _ in range(12):
            texts.append(" ".join(words))
            for _ in range(r.randrange(2)):
                words[r.randrange(300)] = f"new{r.randrange(10**6)}"
    texts += [None, "", "one", "ONE", "two words", "two words more"]
    of = groups([simhash(t) for t in texts])
    assert 14 < len(set(of)) < len(texts) - 40
    made = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, _keep int").repartition(5)
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    out = stage(spark, made, str(tmp_path))
    assert out.columns == made.columns and all(x.doc_id == x._keep for x in out.collect())
    assert sorted(x.doc_id for x in out.collect()) == sorted(set(of))
    out = stage(spark, documents, str(tmp_path))
    assert out.columns == documents.columns and out.where("doc_id IS NULL").count() == 1
    assert stage(spark, empty, str(tmp_path)).count() == 0


def test_known_pieces_are_looked_up_once(monkeypatch):
    """A piece whose ids are stored costs one look into the store, and ids stay those of the whole text."""
    from nearfield.llm import tokens

    looks = []

    class Counted(dict):
        def get(self, *a):
            looks.append(a[0])
            return super().get(*a)

        def __contains__(self, p):
            looks.append(p)
            return super().__contains__(p)

        def __getitem__(self, p):
            looks.append(p)
            return super().__getitem__(p)

    texts = ["", "one two  three\n\n four", "five " + "é" * 80 + " six", "x" * 200, "one two one two", " \t "]
    monkeypatch.setattr(tokens, "_HOME", "_nearfield_piece_store_of_a_test")
    encoder = tokens.TokenEncoder(tokens.default_tokenizer())
    ids, offsets = encoder.encode(texts, 1)
    for i, text in enumerate(texts):
        whole = encoder.store.tokenizer.encode(text, add_special_tokens=False).ids + [1]
        assert ids[offsets[i] : offsets[i + 1]].tolist() == whole
    encoder.store.number = Counted(encoder.store.number)
    again, _ = encoder.encode(["one two one two", "", "one two  three\n\n four"], 1)
    pieces = tokens.PIECE.findall("one two one two") + tokens.PIECE.findall("one two  three\n\n four")
    assert looks == pieces
    assert again.tolist() == [*ids[offsets[4] : offsets[5]].tolist(), 1, *ids[offsets[1] : offsets[2]].tolist()]


def test_punctuation_behind_words_costs_no_encoding(monkeypatch):
    """Words are encoded once whatever punctuation follows them; ids stay those of the whole text, white space of any kind."""
    from nearfield.llm import tokens

    monkeypatch.setattr(tokens, "_HOME", "_nearfield_piece_store_of_another_test")
    encoder = tokens.TokenEncoder(tokens.default_tokenizer())
    whole, calls = encoder.store.tokenizer, []

    class Counted:
        def encode_batch_fast(self, texts, **how):
            calls.append("".join(texts))
            return whole.encode_batch_fast(texts, **how)

        def encode(self, text, **how):
            return whole.encode(text, **how)

    encoder.store.tokenizer = Counted()
    texts = ["one two. three, Zürich! 7%", "two two! two?! (two) three. three, Zürich. 7%. 7, don't. it's, x!'s y'll."]
    texts += ["<|endoftext|>. a<|endoftext|>, b.", "a.b. c,d,, ..e ). é. ŋ! 日本. я! ٣. x́. _. ½. ²! ª.", "w" * 70 + ". " + "v" * 63 + ".."]
    texts += ["", " ", "\n", "  ", " \n", "a ", "a  ", "a\n\n", "\n\n\na", " \n a", "a \n b", "a   b", "a\t b", "a\0 b\0", "a b c", ". .", "\r\n\r\nx."]
    for found, text in ((tokens.pieces_of(t), t) for t in texts):
        assert found == tokens.PIECE.findall(text)
    for _ in range(2):
        ids, offsets = encoder.encode(texts, 1)
        for i, text in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids + [1]
    assert len(calls) == 1 and calls[0].count("three") == calls[0].count("Zürich") == 1


def test_a_full_store_keeps_the_pieces_in_use(monkeypatch):
    """Beyond its bound the store gives up rare pieces only; ids stay those of the whole text."""
    from nearfield.llm import tokens

    monkeypatch.setattr(tokens, "_HOME", "_nearfield_piece_store_of_a_third_test")
    monkeypatch.setattr(tokens, "STORE_PIECES", 500)
    encoder = tokens.TokenEncoder(tokens.default_tokenizer())
    whole, calls = encoder.store.tokenizer, []

    class Counted:
        def encode_batch_fast(self, texts, **how):
            calls.append("".join(texts))
            return whole.encode_batch_fast(texts, **how)

        def encode(self, text, **how):
            return whole.encode(text, **how)

    encoder.store.tokenizer = Counted()
    for at in range(20):
        texts = ["the Zürich, often" * 3 + "".join(f" w{at}x{i}." for i in range(100)), "often the Zürich, often " + "v" * 80]
        ids, offsets = encoder.encode(texts, 1)
        for i, text in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids + [1]
        assert len(encoder.store.number) <= 500 + 250
    assert "".join(calls).count("Zürich") == 1


def test_memory_of_word_scores():
    """Scoring long words takes some megabytes, however many there are, as it stays with the worker."""
    import tracemalloc

    from nearfield.llm.langid import WORD_BYTES, Pieces, default_vocabulary, word_scores

    pieces = Pieces(default_vocabulary())
    log_p = np.log(np.full((pieces.n, 8), 1 / pieces.n))
    data = np.resize(np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8), 6_000 * WORD_BYTES)
    starts = np.arange(6_000) * WORD_BYTES
    tracemalloc.start()
    word_scores(pieces, log_p, data, starts, np.full(6_000, WORD_BYTES))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 << 20


def test_memory_of_the_id_coder():
    """Coding 1,024 blocks touches little beyond the model, and a file's writer holds ids at their width."""
    import io
    import subprocess
    import sys

    from nearfield.llm.tokenfile import TokenFileWriter

    code = """
import re, numpy as np
from nearfield.llm.idcoder import encode_blocks
def peak():
    return int(re.search(r"VmHWM:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
ids = (np.random.default_rng(1).zipf(1.3, (1024, 4096)) % 50_000).astype(np.uint16)
before = peak()
encode_blocks(list(ids), 4)
print(peak() - before)
"""
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=words.__file__.rsplit("/", 3)[0])
    assert float(found.stdout) < 40
    writer = TokenFileWriter(io.BytesIO(), 4)
    writer.add(1, np.arange(1000, dtype=np.uint32))
    assert sum(w.nbytes for w in writer.waiting) == 2000


def test_white_space_before_an_added_token(tokenizer):
    """The tokenizer takes added tokens out of a text before it cuts the rest."""
    encoder = TokenEncoder(default_tokenizer())
    for text in ("\n\n<|endoftext|>", "a  <|endoftext|>  b. <|endoftext|><|endoftext|>\n\n\n", "x <|endoftext|> <|endoftext|>.", "<|endoftext|"):
        assert encoder.encode([text], 1)[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1]


def test_steps_of_the_id_coder():
    """A step of all blocks is a bounded number of calls, and payloads stay readable: they are those of earlier versions."""
    import cProfile
    import pstats

    state, blocks = 1, []
    for n in (1, 900, 3, 2000, 700):
        ids = []
        for _ in range(n):
            state = (state * 1103515245 + 12345) % 2**31
            ids.append(min(50_256, 2**31 // (state + 1)) if state % 3 else len(ids) % 7)
        blocks.append(np.array(ids, dtype=np.uint32))
    for nibbles, digest in ((4, "51e65453fcbd3254"), (7, "ca664b5448177d18")):
        payloads = encode_blocks(blocks, nibbles)
        assert hashlib.sha256(b"".join(payloads)).hexdigest()[:16] == digest
        assert [ids.tolist() for ids in decode_blocks(payloads, [len(b) for b in blocks], nibbles)] == [b.tolist() for b in blocks]

    same = [blocks[3]] * 40
    payloads = encode_blocks(same, 4)
    for code, most in ((lambda: encode_blocks(same, 4), 140), (lambda: decode_blocks(payloads, [2000] * 40, 4), 175)):
        profile = cProfile.Profile()
        profile.runcall(code)
        assert pstats.Stats(profile).total_calls < most * 2000


# --- op 8, storage ------------------------------------------------------------------------

def test_storage_of_counts_and_places(rng, tmp_path):
    n = np.array([0, 1, 254, 255, 256, 70_000, 2**40, 3], dtype=np.int64)
    facts = np.array([[1, 15, 14, 2**33, 0], [1, 0, 14, 9, 0], [0, 0, 0, 20, 0], [0, 5, 0, 2, 0]], dtype=np.int64)
    starts = np.array([0, 0, 3, 65_535, 65_536, 200_000, 200_001, 1_000_000])
    path = kneserney._write_array(f"file://{tmp_path}/a", 0, [*kneserney._counts(n), *kneserney._facts(facts), *kneserney._places(starts)])
    columns = kneserney.read_array(path)
    some = rng.integers(0, 8, 50)
    assert kneserney._counts_at(columns[:3], some).tolist() == n[some].tolist()
    assert kneserney._facts_at(columns[3:6], some % 5).tolist() == facts[:, some % 5].tolist()
    assert kneserney._places_at(columns[6:], some).tolist() == starts[some].tolist()
    packed = kneserney._unpack(kneserney._pack(n, n[:0], starts))
    assert [p.tolist() for p in packed] == [n.tolist(), [], starts.tolist()]


@pytest.mark.parametrize("most", [5, 2**22, 2**31])
def test_keys_of_triples_keep_their_order(rng, most):
    u, w, t = (rng.integers(0, most, 300) for _ in range(3))
    u[:100], w[:50] = u[0], w[0]
    key, how = kneserney._keys(u, w, t)
    ordered = key[np.lexsort((t, w, u))]
    assert (ordered[1:] >= ordered[:-1]).all()
    assert [x.tolist() for x in kneserney._unkeyed(np.sort(key), how)] == [list(c) for c in zip(*sorted(zip(u.tolist(), w.tolist(), t.tolist())))]


def test_size_of_a_trigram_model(spark):
    """N-grams take a few bytes each: runs below their context, no hash, one byte a count."""
    import os
    import random

    from nearfield.llm.kneserney import fit_ngrams

    r = random.Random(3)
    texts = [[f"w{int(r.paretovariate(0.7)) % 2000}" for _ in range(300)] for _ in range(100)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    model = fit_ngrams(docs)
    paths = [p for v in vars(model).values() if isinstance(v, dict) for p in v.values()]
    size = sum(os.path.getsize(p.removeprefix("file://").removeprefix("file:")) for p in paths)
    texts = [["<", *t, ">"] for t in texts]
    one, two, three = ({tuple(t[i : i + n]) for t in texts for i in range(len(t) + 1 - n)} for n in (1, 2, 3))
    assert size < 32 * len(one) + 6 * len(two) + 9 * len({g[:2] for g in three}) + 4 * len(three) + 2000


def test_trigrams_of_frequent_words(spark):
    """One bigram holds most tokens and has many words before and after it; contexts are spread over shards."""
    import random

    from nearfield.llm.kneserney import fit_ngrams

    r = random.Random(4)
    texts = ["a b " * 400 + "a a " * 300] + [" ".join(f"{r.choice('xyz')}{i % 290} a b y{r.randrange(300)}" for i in range(40)) for _ in range(30)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    train = [t.split() + [">"] for t in texts[:25]]
    triples = Counter(x for t in train for x in zip(["<", *t], t, t[1:]))
    pairs = Counter((v, w) for _, v, w in triples) + Counter(("<", t[0]) for t in train)
    lefts, size = Counter(w for _, w in pairs), len({w for t in train for w in t})

    def level(grams):
        d = (0, *kneserney._discounts(*(sum(1 for c in grams.values() if c == k) for k in (1, 2, 3, 4))))
        mass, rest = Counter(), defaultdict(float)
        for g, c in grams.items():
            mass[g[:-1]] += c
            rest[g[:-1]] += d[min(c, 3)]
        return lambda g, p: p if not mass[g[:-1]] else (grams[g] - d[min(grams[g], 3)] + rest[g[:-1]] * p) / mass[g[:-1]]

    one, two, three = (level(x) for x in (Counter({(w,): c for w, c in lefts.items()}), pairs, triples))

    def score(t):
        t = ["<", *t.split(), ">"]
        p = [two((t[i - 1], t[i]), one((t[i],), 1 / (size + 1))) for i in range(1, len(t))]
        return sum(math.log10(three((t[i - 1], t[i], t[i + 1]), p[i]) if i else p[0]) for i in range(len(p)))

    expected = [(i, round(score(t), 6)) for i, t in enumerate(texts)]
    for shard_tokens in (100_000, 500):
        model = fit_ngrams(docs.where("doc_id < 25"), shard_tokens=shard_tokens)
        assert (len(model.hot) > 1) == (shard_tokens == 500)
        found = score_texts(docs, model).withColumn("score", F.round("score", 6))
        assert sorted(rows(found, "doc_id", "score")) == expected
