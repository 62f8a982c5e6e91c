"""Decontamination, importance resampling and conversation repair against brute force."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import documents, empty, text  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from nearfield.llm.automaton import Automaton
from nearfield.llm.conversations import Repair, damage, repair_digest
from nearfield.llm.crcmatrix import crc32_all
from nearfield.llm.decontaminate import contamination_digest, decontaminate, index_items, match_items
from nearfield.llm.importance import importance_ranks, resample
from nearfield.llm.queries import QUERIES
from nearfield.llm.survivors import Survivors

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode()


def terms(t):
    return TERM.findall(lowered(t))


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def named(key):
    return "" if key is None else str(key)


# --- op 11 --------------------------------------------------------------------------------

DIGEST = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def hits(docs, items, window):
    """Per document: the words inside windows, and the items."""
    windows = {}
    for key, t in items:
        w = terms(t)
        for i in range(len(w) - min(window, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(named(key))
    for key, t in docs:
        w, inside, found = terms(t), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if (own := windows.get(tuple(w[i : i + m]))) is not None:
                    inside |= set(range(i, i + m))
                    found |= own
        yield key, len(w), inside, sorted(found)


def digests(docs, items, window):
    out = [
        (k, n, len(inside), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(inside))
        for k, n, inside, found in hits(docs, items, window)
    ]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_windows_of_items(spark, seed):
    """Few different words, so items overlap, repeat and contain each other; short items; several parts and passes."""
    r = random.Random(seed)
    words = ["a", "B", "É", "c d", "x!", "99"][: 2 + seed]

    def made(n):
        return " ".join(r.choice(words) for _ in range(n))

    docs = [(i, made(r.randrange(700 if i % 10 == 0 else 60))) for i in range(60)] + [(None, None), (1, ""), (5, made(30)), (5, made(30))]
    items = [(i, made(r.choice([0, 1, 2, 3, 5, 9, 10, 11, 40]) if seed != 3 else r.choice([9, 10, 14, 60]))) for i in range(20)]
    items += [(None, made(12)), (3, made(12)), (4, None), (5, items[2][1]), (6, "?! ,")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    window = 4 if seed % 2 else 10
    for parts in ({}, {"part_words": 50, "resident_bytes": 3000}):
        index = index_items(asked, window=window, **parts)
        assert (len(index.groups) > 1) == bool(parts)
        assert rows(contamination_digest(table, index), *DIGEST) == digests(docs, items, window)


def test_contamination_of_odd_rows(spark, documents, empty):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(7, text(1, 3000)), (8, "the 日本語 STRASSE"), (9, "Straße été"), (10, " ".join(text(2, 120).split()[20:33])), (11, "x" * 5000), (11, None)]
    items += items[:1] * 3
    asked = spark.createDataFrame(items, "item_id long, text string")
    index = index_items(asked)
    assert rows(contamination_digest(documents, index), *DIGEST) == digests(docs, items, 10)
    assert contamination_digest(empty, index).count() == 0
    clean = contamination_digest(documents, index_items(asked.limit(0)))
    assert rows(clean, *DIGEST) == digests(docs, [], 10)
    clash = documents.withColumn("spans", F.lit(1)).withColumnRenamed("lang", "t").withColumnRenamed("source", "c0")
    found = match_items(clash, index)
    assert found.columns == ["doc_id", "text", "t", "c0", "n_chars", "id", "n_words", "spans", "items"]
    assert rows(found, "doc_id", "t", "c0", "id") == rows(clash, "doc_id", "t", "c0", "id")


def test_decontaminate(spark):
    item = " ".join(f"w{i}" for i in range(14))
    docs = [
        (1, "é, (" + item + ") end of the text and more of it, in fact a lot more words than were taken out", "t"),
        (2, item + " x", "u"), (3, "clean", "v"), (4, None, "w"),
        (5, "one two three four five six seven. " + item.upper() + "! and nine ten eleven twelve thirteen, fourteen. " * 2, "x"),
    ]
    table = spark.createDataFrame(docs, "doc_id long, text string, spans string")
    index = index_items(spark.createDataFrame([(0, item)], "item_id long, text string"))
    got = {r.doc_id: (r.text, r.spans) for r in decontaminate(table, index, most_share=0.9).collect()}
    expected = {k: (t if t is None else re.sub(item, "", t, flags=re.I), s) for k, t, s in docs if k != 2}
    assert got == expected
    assert {r.doc_id for r in decontaminate(table, index, most_share=0.9, least_words=15).collect()} == {1, 3, 4, 5}
    assert {r.doc_id for r in decontaminate(table, index, most_share=0.0).collect()} == {3, 4}


def test_match_lengths():
    """States and lengths at every word, against all substrings, over lanes and texts."""
    r = random.Random(4)
    for _ in range(30):
        items = [[r.randrange(3) for _ in range(r.randrange(1, 30))] for _ in range(4)]
        automaton = Automaton.build(((i, [b"%d" % w for w in own], True) for i, own in enumerate(items)), 3)
        automaton = Automaton.load(automaton.dump())
        numbers = {w: i for i, w in enumerate(automaton.vocabulary.to_pylist())}
        parts = {tuple(own[a:b]) for own in items for a in range(len(own)) for b in range(a + 1, len(own) + 1)}
        texts = [[r.randrange(4) for _ in range(r.choice([0, 1, 40, 700]))] for _ in range(5)]
        first = np.append(0, np.cumsum([len(t) for t in texts]))
        words = np.array([numbers.get(b"%d" % w, -1) for t in texts for w in t], dtype=np.int64)
        place, _, size = automaton.stream(words, first)
        got, least, most = dict(zip(place.tolist(), size.tolist())), automaton.least, automaton.most
        for t, a in zip(texts, first.tolist()):
            for i in range(len(t)):
                best = max((n for n in range(1, min(i + 1, most) + 1) if tuple(t[i + 1 - n : i + 1]) in parts), default=0)
                assert min(got.get(a + i, 0), most) == (best if best >= least else 0)


# --- op 12 --------------------------------------------------------------------------------

RANKS = ["doc_id", "n_features", "weight", "score", "rank"]


def features(t):
    w = terms(t)
    return w + [a + b" " + b for a, b in zip(w, w[1:])]


def ranked(docs, target, percent=25, least=20, buckets=10_000):
    def bucket(f):
        return zlib.crc32(f) % buckets

    s = Counter(bucket(f) for _, t in docs for f in features(t))
    t = Counter(bucket(f) for x in target for f in features(x))
    raw, wanted = sum(s.values()), sum(t.values())
    out = []
    for key, x in docs:
        f = features(x)
        gains = [math.floor(1000 * math.log((t[bucket(y)] + 1) * (raw + buckets) / ((s[bucket(y)] + 1) * (wanted + buckets)))) for y in f]
        weight = sum(gains) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{named(key)}".encode()).hexdigest()[:8], 16)
        out.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(terms(x))])
    able = sorted((o for o in out if o[5] >= least), key=lambda o: (-o[3], -1 if o[0] is None else o[0]))
    for place, o in enumerate(able[: percent * len(able) // 100], 1):
        o[4] = place
    return sorted((tuple(o[:5]) for o in out), key=repr)


def test_crc_of_many():
    r = random.Random(2)
    strings = [r.randbytes(r.choice([0, 1, 2, 5, 5, 5, 17, 300])) for _ in range(500)] + [r.randbytes(1024), r.randbytes(1025), b"x" * 9000]
    for cells in (1, 64, 1 << 20):
        assert crc32_all(pa.array(strings, pa.large_binary()), cells).tolist() == [zlib.crc32(x) for x in strings]
    assert crc32_all(pa.array(strings, pa.large_binary()).slice(7, 90)).tolist() == [zlib.crc32(x) for x in strings[7:97]]
    assert crc32_all(pa.array([], pa.large_binary())).tolist() == []


def test_importance_ranks(spark, documents, empty):
    r = random.Random(1)
    words = ["a", "B", "É", "c d", "x!", "99", "x" * 2000, "日本"] + [f"w{i}" for i in range(300)]

    def made(n):
        return " ".join(r.choice(words) for _ in range(n))

    docs = [(i, made(r.randrange(700 if i % 10 == 0 else 60))) for i in range(200)] + [(None, None), (1001, ""), (1002, "?")]
    target = [(made(30),) for _ in range(20)] + [(None,)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    wanted = spark.createDataFrame(target, "text string")
    found = importance_ranks(table, wanted)
    assert rows(found, *RANKS) == ranked(docs, [t for t, in target])
    drawn = resample(table.withColumn("rank", F.lit(1)), wanted)
    assert drawn.columns == ["doc_id", "text", "rank"]
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(x[0] for x in rows(found, *RANKS) if x[4])
    odd = [(r.doc_id, r.text) for r in documents.collect()]
    for target_rows in (wanted, wanted.limit(0)):
        expected = ranked(odd, [x.text for x in target_rows.collect()])
        assert rows(importance_ranks(documents, target_rows), *RANKS) == expected  # repeated rows have no score in common with others
    assert importance_ranks(empty, wanted).count() == 0


# --- op 13 --------------------------------------------------------------------------------

REPAIR = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
KEEPS, FORCED, ROLES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}), (2, 2, 3, 2), {2: "user", 3: "assistant"}
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def damaged(given):
    for key, turn, role, said in given:
        role, said = (" " if x is None else x for x in (role, said))
        kind = zlib.crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20
        said = "" if kind == 1 else re.sub("[.!?]", "", said) if kind == 2 else said
        yield from [(key, turn, "user" if kind == 4 else role, said)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def cheapest(own):
    """Faults, cost, edits and turns, by a search in order of (cost, edits)."""
    seen, faults = set(), []
    for _, role, said in own:
        ends = VISIBLE.findall(said)
        faults.append("b" if not ends else "d" if (role, said) in seen else "t" if ends[-1] not in ".!?" else "")
        seen.add((role, said))
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(own) and state in (0, 3):
            return faults, cost, audit, out
        to = FORCED[state]
        heapq.heappush(heap, (cost + 3, audit + "I", i, to, (*out, f"{ROLES[to]}:")))
        if i < len(own):
            _, role, said = own[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
            if faults[i] not in ("b", "d"):
                more = 3 if faults[i] else 0
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, to, (*out, f"{ROLES[to]}:{said}")))
                if role[:1] in KEEPS[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, KEEPS[state][role[:1]], (*out, f"{role}:{said}")))


def repaired(given):
    own, out = {}, []
    for key, *_ in given:
        own.setdefault(key, [])
    for key, *row in damaged(given):
        own[key].append(tuple(row))
    for key, turns in own.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        faults, cost, audit, lines = cheapest(turns)
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((key, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def conversations(seed):
    r, out = random.Random(seed), []
    for key in [*range(40), None]:
        for turn in range(300 if key == 7 else r.choice([1, 2, 3, 8, 30])):
            if r.random() < 0.1:
                continue
            role = ["user", "assistant"][turn % 2]
            if r.random() < 0.4:
                role = r.choice(["user", "assistant", "user", "assistant", "system", None, "tool", ""])
            said = r.choice(["Hi.", "Yes! ", "no", "cut off", "a.b", "\n \t", None, "", "Ok?\n", "😀"])
            if said is not None:
                said += (str(turn) if r.random() < 0.5 else "") + r.choice([".", "", "!"])
            out.append((key, None if turn == 2 else turn, role, said))
    return out


@pytest.mark.parametrize("block_rows", [1 << 14, 7, 1])
def test_conversation_repair(spark, block_rows):
    """Whole conversations, and such that are cut into blocks of a few rows or one."""
    given = conversations(block_rows)
    table = spark.createDataFrame(given, "conv_id long, turn long, role string, text string").repartition(4)
    assert rows(repair_digest(table, block_rows=block_rows), *REPAIR) == repaired(given)


def test_conversation_with_most_rows(spark):
    given = [(1, t, "user" if t % 3 else "assistant", f"{t}.") for t in range(3000)] + [(2, t, "user", "Again.") for t in range(900)]
    table = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    assert rows(repair_digest(table, block_rows=100), *REPAIR) == repaired(given)
    assert repair_digest(table.limit(0)).count() == 0
    clash = table.selectExpr("conv_id at", "turn block", "role edit", "text conv", "1 step")
    found = repair_digest(clash, "at", "block", "edit", "conv", block_rows=100)
    assert rows(found, "at", *REPAIR[1:]) == repaired(given)


def test_repaired_turns(spark):
    given = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 2, "user", "cut"), (1, 3, "assistant", "Yes.")]
    table = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    left = Repair(table.withColumnRenamed("conv_id", "conv")).turns.orderBy("at", "step").collect()
    assert "".join(r.role[0] for r in left) in ("uaua", "ua")
    assert damage(table).columns == ["conv", "turn", "role", "text"]


def test_survivors_are_forgotten():
    """Only undecided edits are held, whatever the length; a path is handed out once."""
    out = []
    run = Survivors(0, lambda text, tag: out.append(text))
    r, most = random.Random(3), 0
    for i in range(20_000):
        run.row("ua"[i % 2] if r.random() < 0.9 else r.choice("uasx"), r.choice([0, 0, 0, 1, 2, 3]))
        nodes, stack = 0, [run.base]
        while i % 50 == 0 and stack:
            nodes, stack = nodes + 1, stack + list(stack.pop().children)
        most = max(most, nodes)
    cost, rest = run.finish()
    audit = "".join(out) + "".join(t for t, _ in rest)
    assert most < 500 and len(audit) - audit.count("I") == 20_000 and cost > 0


def test_registered():
    assert QUERIES["op11_benchmark_decontamination"][1] and QUERIES["op12_importance_resampling"][1]
