"""Operators 11 to 13 against brute force, and on odd tables."""

import random
import zlib
from collections import defaultdict

import brute
from conftest import FOLDER, pairs

from statloom.llm import conversation_repair, lsh_forest, periodic_runs, queries

WORDS = [f"w{k}" for k in range(400)]


# ---- 11 near duplicates by a forest

def by_forest(frame, **more):
    return sorted(map(tuple, lsh_forest.near_duplicates(frame, **more).collect()), key=str)


def test_forest_query(spark, documents):
    found = sorted(map(tuple, queries.op11_lsh_forest(spark, FOLDER).collect()))
    assert found == sorted(brute.forest(pairs(documents)))


def varied(rng, base, share):
    return [rng.choice(WORDS) if rng.random() < share else w for w in base]


def test_dense_regions(spark, monkeypatch):
    """Families whose members are near, nearly near and not near each other, in blocks of few rows."""
    monkeypatch.setattr(lsh_forest, "BLOCK", 4)
    rng, rows = random.Random(11), []
    for family in range(3):
        base = rng.choices(WORDS, k=120)
        for share in (0.0, 0.01, 0.03, 0.05, 0.08):
            rows += [" ".join(varied(rng, base, share)) for _ in range(14)]
    rows += [rows[0]] * 200
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    expected = sorted(brute.forest(rows), key=str)
    assert by_forest(frame) == expected
    assert 1 < sum(kept for *_, kept in expected) < len(rows) - 200


def test_forest_of_odd_rows(spark, odd):
    rows = pairs(odd)
    found = sorted(((i, n, c) for i, n, c, _ in by_forest(odd)), key=str)
    assert found == sorted(((i, n, c) for i, n, c, _ in brute.forest(rows)), key=str)
    named = odd.withColumnsRenamed({"n_words": "component", "words": "set", "id": "region"})
    assert by_forest(named) == by_forest(odd)
    assert by_forest(odd.limit(0)) == []
    none = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (3, None), (3, " \t")], "doc_id long, text string")
    assert by_forest(none) == sorted([(None, 1, None, True)] * 2 + [(3, 0, 3, True)] * 2, key=str)


def test_forest_reaches_its_recall():
    assert 1 - (1 - 0.8 ** lsh_forest.DEPTH) ** lsh_forest.trees_for() >= lsh_forest.RECALL


# ---- 12 periodic runs

def some_words(rng):
    words = []
    for _ in range(rng.randint(0, 8)):
        kind = rng.random()
        if kind < 0.4:
            period = rng.randint(1, rng.choice([3, 20, 60]))
            block = [str(rng.randint(0, rng.choice([1, 2, 9]))) for _ in range(period)]
            words += [block[k % period] for k in range(rng.randint(0, 6 * period + 20))]
        elif kind < 0.6 and words:
            at = rng.randrange(len(words))
            words += words[at:at + rng.randint(0, 80)]
        else:
            words += [str(rng.randint(0, 3)) for _ in range(rng.randint(0, 20))]
    return words


def test_runs_of_several_texts_together():
    rng, some = random.Random(1), 0
    for _ in range(400):
        texts = [some_words(rng) for _ in range(rng.randint(1, 4))]
        for words, (found, left) in zip(texts, periodic_runs.runs_of([[w.encode() for w in t] for t in texts])):
            expected = brute.runs(words)
            assert list(map(tuple, found.tolist())) == expected
            assert b" ".join(left).decode() == brute.collapsed(words, expected)
            some += len(expected)
    assert some > 500


def test_blocks_of_repeated_parts():
    """No window of a block of such parts is the only one of its kind."""
    a, b = ([f"{name}{k}" for k in range(20)] for name in "ab")
    words = (a * 3 + b * 3 + a + b) * 4
    (found, _), = periodic_runs.runs_of([[w.encode() for w in words]])
    assert list(map(tuple, found.tolist())) == brute.runs(words)


def test_one_long_run_is_quick():
    (found, left), = periodic_runs.runs_of([[b"a"] * 200_000])
    assert found.tolist() == [[0, 200_000, 1]] and left == [b"a"]


def repeated(name, text):
    words, h = brute.plain_words(text), zlib.crc32(str(name).encode())
    if h % 10 == 0 and words and name is not None:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def report_of_runs(name, words):
    from hashlib import sha256

    found = brute.runs(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    return (name, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest(),
            sha256(brute.collapsed(words, found).encode()).hexdigest())


def test_runs_query(spark, documents):
    rows = [r for r in pairs(documents) if len(r[1] or "") < 20_000]
    expected = {i: report_of_runs(i, repeated(i, t)) for i, t in rows}
    found = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, FOLDER).collect()}
    assert {i: found[i] for i in expected} == expected and len(found) == documents.count()
    assert sum(r[1] for r in expected.values()) > 10


def test_runs_of_odd_rows(spark, odd):
    found = periodic_runs.scan(odd).collect()
    assert len(found) == odd.count() and periodic_runs.scan(odd.limit(0)).collect() == []
    for r in found:
        if r["doc_id"] == 9:
            assert [tuple(x) for x in r["runs"]] == [(0, 30_000, 1)] and r["collapsed"] == "word"
        else:
            assert r["runs"] == []
    empty = [r for r in found if r["doc_id"] in (2, 3, 11)]
    assert [(r["n_words"], r["collapsed"]) for r in empty] == [(0, "")] * 3


# ---- 13 conversations

def by_report(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    return {r[0]: tuple(r)[1:] for r in conversation_repair.report(conversation_repair.repair(frame), frame).collect()}


def by_brute(rows):
    held = defaultdict(list)
    for name, *row in rows:
        held[name].append(row)
    return {name: brute.repaired(own) for name, own in held.items()}


def some_rows(rng, name, n):
    texts = ["", " \t", "Yes.", "No!", "cut off", "Why? ", "um", None, "été."] + [f"line {k}." for k in range(40)]
    turn, rows = 0, []
    for _ in range(n):
        turn += rng.choice([0, 1, 1, 1, 2])
        rows.append((name, rng.choice([turn] * 9 + [None]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""]),
                     rng.choice(texts)))
    return rows


def test_repair_against_all_edits(spark):
    rng = random.Random(13)
    rows = [r for name in [*range(150), None] for r in some_rows(rng, name, rng.randint(1, 12))]
    assert by_report(spark, rows) == by_brute(rows)
    assert by_report(spark, rows, 1) == by_brute(rows)


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(14)
    rows = some_rows(rng, 7, 400) + [(k, 0, "user", f"Hello {k}.") for k in range(20)]
    assert by_report(spark, rows, 8) == by_brute(rows)
    n = 2 * conversation_repair.SEGMENT_ROWS + 100
    rows = [(1, k, ("user", "assistant")[k % 2], f"Message {k}" + ".!"[k % 2]) for k in range(n)]
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = by_report(spark, rows)[1]
    assert (gaps, blank, duplicate, truncated, illegal, cost, audit) == (0, 0, 0, 0, 0, 0, "K" * n)


def damaged(rows):
    made = defaultdict(list)
    for name, turn, role, text in rows:
        fault = zlib.crc32(f"{name}:{turn}".encode()) % 20
        if fault:
            text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
            made[name] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
        else:
            made[name] += []
    return made


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {name: brute.repaired(own) for name, own in damaged(rows).items()}
    found = {r["conv_id"]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, FOLDER).collect()}
    assert found == expected


def test_repair_of_odd_tables(spark):
    schema = "conv_id string, turn int, role string, text string, conversation string, part int, mark string, later int, low int"
    frame = spark.createDataFrame([("a", 1, "user", "Hi.", "x", 1, "m", 2, 3), ("a", 1, "user", "Hi.", "y", 1, "m", 2, 3),
                                   ("b", None, None, None, "x", 1, "m", 2, 3), ("c", 5, "system", "z" * 300_000 + ".", None, 1, "m", 2, 3)], schema)
    pieces = conversation_repair.repair(frame)
    made = {r[0]: tuple(r)[1:8] for r in conversation_repair.report(pieces, frame).collect()}
    assert made == {"a": (0, 0, 1, 0, 1, 7, "KDI"), "b": (0, 1, 0, 0, 0, 4, "D"), "c": (0, 0, 0, 0, 0, 4, "D")}
    said = [(r["conversation"], r["role"], r["text"]) for r in conversation_repair.messages(pieces).collect()]
    assert sorted(said) == [("a", "assistant", ""), ("a", "user", "Hi.")]
    empty = frame.limit(0)
    assert conversation_repair.report(conversation_repair.repair(empty), empty).collect() == []
    lost = conversation_repair.report(conversation_repair.repair(empty), frame.select("conv_id")).collect()
    assert len(lost) == 3 and all(tuple(r)[1:8] == (0, 0, 0, 0, 0, 0, "") for r in lost)
