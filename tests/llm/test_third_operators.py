"""Hard negatives, conversation tries and shingle joins against brute force on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest

from tallyhouse.llm import hard_negatives, prefix_trie, shingle_join
from tallyhouse.llm.oracle import ORACLE_SQL


def brute_negatives(rows):
    """Contract of hard negatives in plain Python integers."""
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, [math.floor(256 * x) for x in vector], label))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, (vec_id, vector, label) in enumerate(kept):
        if vec_id is None or vec_id % 100:
            continue
        scored = [
            (sum(a * b for a, b in zip(vector, v, strict=False)), other, lab)
            for j, (other, v, lab) in enumerate(kept)
            if i != j
        ]
        near = sorted((x for x in scored if x[2] == label), key=order)[:5]
        far = sorted((x for x in scored if x[2] != label), key=order)
        for score, positive, _ in near:
            fits = [x for x in far if 80 * score <= 100 * x[0] <= 100 * score][:5]
            out += [(vec_id, positive, k + 1, x[1], score, x[0]) for k, x in enumerate(fits)]
    return out


def odd_vectors():
    rng = random.Random(3)
    rows = []
    for i in range(400):
        center = rng.randrange(4)
        vector = [rng.gauss(1.0 if k == center else 0.0, 0.4) for k in range(8)]
        rows.append((i * 25 - 100, vector, rng.choice([center, center, 7])))
    same = [0.5, -0.25, 0.125, 1.0, 0.0, 0.0, 0.75, 0.5]
    rows += [(10_000 + i, same, i % 3) for i in range(150)]  # one very common vector
    rows += [(700, same, 1), (700, same, 1), (700, same, 2), (None, same, 1), (None, same, 2), (None, same, 2)]
    rows += [(20_000, [], 1), (20_100, [0.0] * 8, 1), (20_200, [1.0, 2.0], 0), (20_300, [0.5] * 12, 2)]
    rows += [(20_400, None, 1), (20_500, same, None), (20_600, [*same[:7], None], 1)]
    rows += [(20_700, [*same[:7], float("nan")], 1), (20_800, [*same[:7], float("inf")], 1)]
    rows += [(20_900, [-x for x in same], 5), (21_000, [1e4 * x for x in same], 2), (21_001, [9e3 * x for x in same], 3)]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int, shelf int, payload string, rank int"


def vector_table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], VECTORS)


@pytest.fixture
def tiny_parts(monkeypatch):
    """Many shelves, buckets, packs and chunks; lists instead of products wherever possible."""
    for name, value in (("LEAST_ROWS", 64), ("BUCKET_ROWS", 32), ("PACK", 3), ("CHUNK", 20)):
        monkeypatch.setattr(hard_negatives, name, value)


@pytest.mark.parametrize("dense", [1 / 3, 0.999])
def test_hard_negatives_on_odd_vectors(spark, multiset, tiny_parts, monkeypatch, dense):
    monkeypatch.setattr(hard_negatives, "DENSE", dense)
    rows = [(i, v and [np.float32(x).item() if x is not None else None for x in v], y) for i, v, y in odd_vectors()]
    df = vector_table(spark, rows).repartition(5)
    assert multiset(hard_negatives.hard_negatives(df).collect()) == multiset(brute_negatives(rows))


def test_hard_negatives_of_whole_shelves(spark, multiset):
    rows = [(i, v and [np.float32(x).item() if x is not None else None for x in v], y) for i, v, y in odd_vectors()]
    found = hard_negatives.hard_negatives(vector_table(spark, rows))
    assert multiset(found.collect()) == multiset(brute_negatives(rows))


def test_hard_negatives_sql_on_odd_vectors(spark, multiset, tmp_path):
    rows = odd_vectors()
    vector_table(spark, rows).select("vec_id", "embedding", "label").toPandas().to_parquet(tmp_path / "e.parquet")
    connection = duckdb.connect()
    connection.execute(f"create view embeddings as from '{tmp_path}/e.parquet'")
    result = connection.execute(ORACLE_SQL["op11_hard_negatives"]).fetchall()
    rows = [(i, v and [np.float32(x).item() if x is not None else None for x in v], y) for i, v, y in rows]
    assert multiset(result) == multiset(brute_negatives(rows))


def test_hard_negatives_of_great_scores_are_exact(spark, multiset):
    rows = [(i, [1e7 + i, float(2**20 + 3 * i), 1.0], i % 2) for i in range(0, 400, 20)]
    rows = [(i, [np.float32(x).item() for x in v], y) for i, v, y in rows]
    found = hard_negatives.hard_negatives(vector_table(spark, rows))
    assert multiset(found.collect()) == multiset(brute_negatives(rows))


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.hard_negatives(vector_table(spark, [])).collect() == []
    assert hard_negatives.hard_negatives(vector_table(spark, [(100, None, 1)])).collect() == []


def test_feasible_ranges_prune(spark):
    """Candidates come from lists and buckets are skipped, not only verified in whole."""
    rng = np.random.default_rng(0)
    whole = np.floor(256 * rng.normal(size=(2000, 8)) * rng.uniform(0.1, 3, 2000)[:, None])
    lengths, unit = hard_negatives._unit(whole)
    order = np.argsort(unit, axis=0, kind="stable").T
    values = np.take_along_axis(unit.T, order, axis=1).astype(np.float32)
    zero = np.zeros(2000, np.int64)
    ids = np.arange(2000)
    bucket = hard_negatives.Bucket(lengths.max(), whole, ids, zero > 0, zero, ids, order, values)
    for query in range(0, 2000, 100):
        least = 0.9 * lengths[query] * bucket.top
        ranges = hard_negatives._ranges(bucket, unit[query : query + 1], np.array([0.9]))
        focus, low, high, first, last = (x[0] for x in ranges)
        assert (last - first).min() < 1000
        reached = np.flatnonzero(whole @ whole[query] >= least)
        for f, a, b in zip(focus, first, last, strict=True):
            assert set(reached) <= set(order[f, a:b])


def brute_trie(rows):
    """Contract of the trie over (conv_id, turn, role, text) rows."""
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [x[2:] for x in sorted(t)] for c, t in talks.items()}
    made = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = talks.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    saved = {
        p: (len(m) - 1) * (len(p[-1][1].encode().split()) if p else 0) for p, m in members.items()
    }
    inner = {p[:-1] for p in members if p}
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in m if len(made[c]) == len(p))))
        out.append(
            (
                min(m),
                len(p),
                min(members[p[:-1]]) if p else None,
                len(m),
                sum(len(q) == len(p) + 1 for q in below),
                sum(q not in inner for q in below),
                sum(saved[q] for q in below),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return out


def odd_talks():
    rng = random.Random(9)
    lines = ["", None, "hello there", " two\x0b words ", "é 日本 x", "z" * 200, "a\x1cb \x85 c", "same line here"]
    rows = []
    for c in [*range(-45, 130, 3), 20, 40, 60, 80, 100, 1_000_001, 1_000_020]:
        for t in range(rng.choice([1, 1, 2, 3, 4, 9])):
            turn = rng.choice([t, t, None, 0])
            rows.append((c, turn, rng.choice(["user", "assistant", None, ""]), rng.choice(lines)))
    for c in (200, 201, 202, 219):  # long, alike for a long way
        rows += [(c, t, "user", "part" if t < 60 else f"part {c}") for t in range(75)]
    rows += [(300 + c, t, "user", "copy of it") for c in range(40) for t in range(6)]
    rows += [(None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(200, 7, "user", "part")] * 3
    return rows


TALKS = "conv_id long, turn long, role string, text string, key string, words int, path string, place int"


def talk_table(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "p", 2) for r in rows], TALKS)


@pytest.mark.parametrize("height", [2, 3, 16])
def test_trie_on_odd_conversations(spark, multiset, height):
    rows = odd_talks()
    random.Random(1).shuffle(rows)
    df = talk_table(spark, rows).repartition(5)
    assert multiset(prefix_trie.trie(df, height).collect()) == multiset(brute_trie(rows))


def test_trie_sql_on_odd_conversations(spark, multiset, tmp_path):
    rows = odd_talks()
    talk_table(spark, rows).select("conv_id", "turn", "role", "text").toPandas().astype(
        {"conv_id": "Int64", "turn": "Int64"}
    ).to_parquet(tmp_path / "c.parquet")
    connection = duckdb.connect()
    connection.execute(f"create view conversations as from '{tmp_path}/c.parquet'")
    result = connection.execute(ORACLE_SQL["op12_prefix_trie"]).fetchall()
    assert multiset(result) == multiset(brute_trie(rows))


def test_trie_of_one_conversation_that_holds_most_rows(spark, multiset):
    """Its turns are numbered over several partitions, and its ids hashed over several pieces."""
    rows = [(40, t, "user", f"turn {t % 7}") for t in range(700)] + [(41 + c, 0, "user", "x") for c in range(50)]
    df = talk_table(spark, rows).repartition(4)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        placed = prefix_trie.numbered(df).where("conv_id = 40").collect()
    finally:
        spark.conf.set(merging, "true")
    assert sorted(r.place for r in placed) == list(range(700))
    assert len({r.part for r in placed}) > 1
    assert multiset(prefix_trie.trie(df).collect()) == multiset(brute_trie(rows))


def test_trie_hashes_many_ids_in_pieces(spark, multiset, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = [(c, 0, "user", "the same") for c in range(100, 180)] + [(5, 0, "user", "other")]
    assert multiset(prefix_trie.trie(talk_table(spark, rows)).collect()) == multiset(brute_trie(rows))


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(talk_table(spark, [])).collect() == []
    assert prefix_trie.trie(talk_table(spark, [(None, 1, "user", "x")])).collect() == []


def brute_shingles(text, words_each=4):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(len(words), words_each)
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_join(rows, percent=85):
    """(doc_id, size, component) of (doc_id, text) rows, all pairs compared."""
    found = [brute_shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(found):
        for j in range(i):
            y = found[j]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return [
        (d, len(x), least.get(top(i)) if x else d) for i, ((d, _), x) in enumerate(zip(rows, found, strict=True))
    ]


def near_texts(n, seed=4):
    """Groups around the similarity bound: chains, short texts, common passages, a large group."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    common = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(n // 12):
        base = [word() for _ in range(rng.choice([3, 4, 6, 25, 40, 90, 200]))]
        for _ in range(rng.choice([1, 2, 5])):
            texts.append(" ".join(base))
            for _ in range(rng.choice([0, 1, 1, 2, 3])):  # a chain: each text edits the one before
                base[rng.randrange(len(base))] = word()
        if rng.random() < 0.3:
            texts.append(" ".join(base) + " " + common)
            texts.append(common + " " + " ".join(base))
    group = [word() for _ in range(70)]
    for _ in range(n // 4):
        some = list(group)
        for _ in range(rng.choice([0, 1, 1, 1, 2])):
            some[rng.randrange(len(some))] = word()
        texts.append(" ".join(some).upper() if rng.random() < 0.1 else " ".join(some))
    return texts + [common] * 3 + ["a b c", "A b\tc", "a b", "a", "c b a", "a b c d", "a b c d e"]


def text_table(spark, rows):
    schema = "doc_id long, text string, sig string, n long, prefix string, block int"
    return spark.createDataFrame([(*r, "s", 1, "p", 2) for r in rows], schema)


@pytest.mark.parametrize("cell", [4096, 8])
def test_shingle_join_on_near_texts(spark, multiset, monkeypatch, cell):
    monkeypatch.setattr(shingle_join, "CELL", cell)
    monkeypatch.setattr(shingle_join, "AT_ONCE", 50)
    for seed in (4, 5):
        rows = [(7 * i % 1009, t) for i, t in enumerate(near_texts(300, seed))]
        df = text_table(spark, rows).repartition(4)
        assert multiset(shingle_join.groups(df).collect()) == multiset(brute_join(rows))


def test_shingle_join_on_odd_documents(spark, odd, multiset):
    docs, rows = odd
    assert multiset(shingle_join.groups(docs).collect()) == multiset(brute_join([r[:2] for r in rows]))


def test_shingle_join_of_null_ids_and_nothing(spark, multiset, none):
    rows = [(None, "one two three four five"), (None, "one two three four five"), (None, None), (3, "")]
    assert multiset(shingle_join.groups(text_table(spark, rows)).collect()) == multiset(brute_join(rows))
    assert shingle_join.groups(none).collect() == []


def test_shingle_join_compares_few_pairs_of_a_large_group(spark, monkeypatch):
    """Copies of one text with an edit each: links to leaders, not all pairs."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(200):
        some = list(base)
        some[rng.randrange(300)] = f"edit{i}"
        texts.append((i, " ".join(some)))
    sizes = []
    real = shingle_join.compared

    def counted(found, pairs):
        df = real(found, pairs)
        sizes.append(df.count())
        return df

    monkeypatch.setattr(shingle_join, "compared", counted)
    result = shingle_join.groups(text_table(spark, texts)).collect()
    assert {r.component_id for r in result} == {0}
    assert sum(sizes) < 200 * 12  # all pairs would be 19,900


def test_shingle_keys_are_those_of_words(spark):
    known = shingle_join._Words()
    a = shingle_join.shingle_keys(b"A b c d e", known)
    assert len(a) == 2 and len(np.intersect1d(a, shingle_join.shingle_keys(b"x a  B c\x0bd", known))) == 1
    assert not len(np.intersect1d(shingle_join.shingle_keys(b"a b c", known), a))
