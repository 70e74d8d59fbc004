"""Quality rules, SimHash, personal data, mixing and BPE against brute force."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tallyhouse.llm import byte_bpe, mixing, pii, quality_rules, queries, simhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# Quality rules


def brute_measures(text):
    words = WORDS.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] >= 2:
            inside.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(inside),
    )


def test_quality_measures(corpus, multiset):
    docs, rows = corpus
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
    got = quality_rules.ledger(docs).select(*names).collect()
    assert multiset(got) == multiset((r[0], *brute_measures(r[1])) for r in rows)


def test_quality_policies(odd, none, multiset):
    docs, rows = odd
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    table = quality_rules.ledger(docs)
    n = table.where(quality_rules.passes()).count()
    assert kept.count() == n < len(rows)
    found = {r.rule: r for r in quality_rules.ablations(table).collect()}
    bits = [r.failed for r in table.select("failed").collect()]
    for i, rule in enumerate(quality_rules.RULES):
        assert found[rule].failing == sum(b >> i & 1 for b in bits)
        assert found[rule].only_this == sum(b == 1 << i for b in bits)
    assert quality_rules.keep(none).count() == 0
    assert quality_rules.ablations(quality_rules.ledger(none)).count() == 0


# SimHash


def brute_print(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORDS.findall(words)
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42)
        for i in range(len(words) - size + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    values = sorted(set(prints))
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    return {v: root(v) for v in values}


@pytest.mark.parametrize("crowd", [0, 48])
def test_simhash(corpus, multiset, crowd):
    docs, rows = corpus
    prints = [brute_print(r[1]) for r in rows]
    roots = brute_components(prints)
    least = defaultdict(list)
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            least[roots[p]].append(r[0])
    expected = [
        (r[0], f"{p:016x}", min(least[roots[p]], default=None))
        for r, p in zip(rows, prints, strict=True)
    ]
    got = simhash.groups(docs, crowd=crowd).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")), "component_id"
    )
    assert multiset(got.collect()) == multiset(expected)


@pytest.mark.parametrize("crowd", [0, 3, 1000])
def test_simhash_links_of_a_dense_group(spark, crowd):
    rng = np.random.default_rng(3)
    values = {0, -1, -(1 << 63)}
    for _ in range(120):
        v = 0x1234567890ABCDEF
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            v ^= 1 << int(b)
        values.add(v - (1 << 64) if v >> 63 else v)
    table = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    edges = simhash.links(table, crowd=crowd)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    roots = brute_components([v & (1 << 64) - 1 for v in values])
    groups = defaultdict(set)
    for v in values:
        groups[roots[v & (1 << 64) - 1]].add(v)
    for group in groups.values():
        assert {got.get(v, v) for v in group} == {min(group)}



def test_simhash_stage_keeps_one_row(spark, odd, none):
    docs, rows = odd
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and kept.schema == docs.schema
    roots = brute_components([brute_print(r[1]) for r in rows])
    least = defaultdict(list)
    for r in rows:
        least[roots[brute_print(r[1])]].append((r[0] is None, r[0] or 0))
    got = [(roots[brute_print(r.text)], (r.doc_id is None, r.doc_id or 0)) for r in kept.collect()]
    assert sorted(got) == sorted((root, min(ids)) for root, ids in least.items())
    assert corpus_pipeline.near_duplicates(spark, none, "").count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    same = [(None, text)] * 3 + [(7, "other words " * 9)] * 2 + [(7, "")]
    kept = simhash.one_of_each(spark.createDataFrame(same, "doc_id long, text string").repartition(3))
    assert sorted(r.text for r in kept.collect()) == sorted({t for _, t in same})


# Personal data


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute_spans(text):
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


PRIVATE = [
    "mail a.b@c.de.com, x@y and _q@e.f.g_h@i.jk @no.de a@b@c.de 😀é@x.yy é.a@b.cc",
    "ip 1.2.3.4.5.6.7.8 0300.1.1.255 1.2.3.256 1.2.3 001.002.003.0004",
    "cards 4111 1111 1111 1111 4111-1111-1111-1111-2 4111  1111 1111 1111 5500005555555559 1-2--3",
    "12 4111111111111111  5500 0055 5555 5559 - 4111111111111111",
    "+1 (212) 555-0100. +49 30 1234567 +1 +12 3456 +1234567890123456 +1+234567890 tel (487) 555-7209",
    "write to joe (at) mail (dot) com or call 212-555-0199 now; order 212-555-0199",
    "1 " * 3000 + "1-" * 3000 + "4" * 20000 + " " * 3000 + "9",
    "a" * 50000 + " 1." * 2000 + "." * 3000 + "x.y" * 10000 + "@",
    None,
    "",
]


def test_pii_base(spark, sample, multiset):
    docs, rows = sample
    rows = [*rows, *((1000 + i, t, None) for i, t in enumerate(PRIVATE))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = pii.personal_data(docs)
    got = [
        (r.doc_id, [(s.start, s.kind, s.end) for s in r.spans if s.base]) for r in found.collect()
    ]
    assert multiset(got) == multiset((r[0], brute_spans(r[1])) for r in rows)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_pii_query_counts_each_kind(spark, tmp_path):
    short = [t for t in PRIVATE if len(t or "") < 1000]
    rows = [*enumerate(short), (None, PRIVATE[0]), (1, PRIVATE[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    expected = []
    for doc, text in rows:
        found = brute_spans(text)
        digest = ",".join(f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in found)
        counts = [sum(s[1] == i for s in found) for i in range(len(pii.KINDS))]
        expected.append((doc, *counts, hashlib.sha256(digest.encode()).hexdigest()))
    got = queries.op1_pii(spark, str(tmp_path)).drop("spans").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_pii_learns_and_redacts(spark, none):
    texts = [f"please call {100 + i}-555-{1000 + i} today" for i in range(40)]
    texts += [f"phone: ({100 + i}) 555-{1000 + i}, or +1 ({100 + i}) 555-{2000 + i}." for i in range(60)]
    texts += [f"order {100 + i}-555-{1000 + i}" for i in range(40)]
    rows = [(i, t, "en", "s", len(t), i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row int"
    )
    learned = pii.reliabilities(pii.candidates(docs)).collect()
    (phone,) = [r for r in learned if r.kind == 3]
    assert 0 < phone.prior < 1 and all(0.5 <= x < 1 for x in phone.reliability)
    done = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert done[45].text == "phone: [PHONE], or [PHONE]."
    assert done[45].n_chars == len(done[45].text)
    assert done[120].text == texts[120]
    assert pii.redact(docs).columns == docs.columns
    assert pii.redact(none).count() == 0 and pii.personal_data(none).count() == 0


def test_pii_redacts_nothing_else(odd, multiset):
    docs, rows = odd
    got = pii.redact(docs).select("doc_id", "text").collect()
    expected = [(r[0], r[1]) for r in rows if not brute_spans(r[1])]
    assert set(map(tuple, expected)) <= set(map(tuple, got)) and len(got) == len(rows)


# Mixing


def brute_seats(votes, seats):
    held = [0] * len(votes)
    for _ in range(seats):
        held[max(range(len(votes)), key=lambda i: (votes[i] / (2 * held[i] + 1), -i))] += 1
    return held


def test_sainte_lague():
    rng = np.random.default_rng(1)
    for _ in range(60):
        votes = rng.integers(0, rng.choice([3, 50, 10_000]), rng.integers(1, 30)).astype(float)
        seats = int(rng.integers(0, 200))
        if votes.sum():
            assert list(mixing.sainte_lague(votes, seats)) == brute_seats(votes, seats)
    assert list(mixing.sainte_lague(np.zeros(3), 5)) == [0, 0, 0]


def brute_targets(rows):
    size = Counter()
    for r in rows:
        size[r[2]] += len(WORDS.findall(r[1] or ""))
    names = sorted([s for s in size if s is not None]) + [None] * (None in size)
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * size[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = 2 * size[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return size, target


def test_mix(corpus, multiset):
    docs, rows = corpus
    size, target = brute_targets(rows)
    sizes = mixing.sized(docs)
    got = mixing.mix(sizes).collect()
    assert multiset((r.doc_id, r.size) for r in got) == multiset(
        (r[0], len(WORDS.findall(r[1] or ""))) for r in rows
    )
    taken = Counter()
    for r in got:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= 2 * mixing.BLOCK_WORDS
    assert multiset(got) == multiset(mixing.mix(sizes).collect())


def test_mixed_documents(odd, none):
    docs, rows = odd
    sizes = {(r.doc_id, r.size): r.taken for r in mixing.mix(mixing.sized(docs)).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id, r.text and (r.doc_id == 4)] += len(WORDS.findall(r.text))
    total = sum(words.values())
    assert abs(total - sum(r.taken for r in mixing.mix(mixing.sized(docs)).collect())) <= 4
    assert sizes and mixing.mixed_documents(none).count() == 0


# BPE


@pytest.fixture(scope="module")
def encoding():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return path, tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.mark.parametrize("block_bytes", [None, 300])
def test_bpe(corpus, multiset, encoding, block_bytes):
    docs, rows = corpus
    path, own = encoding
    got = byte_bpe.encode_decode(
        docs, path, public_tokenizers.PATTERN, block_bytes=block_bytes, parts=3
    ).collect()
    expected = []
    for r in rows:
        text = r[1] or ""
        ids = np.array(own.encode_ordinary(text), "<u4")
        expected.append((r[0], len(ids), bytearray(ids.tobytes()), bytearray(text.encode())))
    assert multiset(got) == multiset(expected)


def test_bpe_digests(sample, none, encoding):
    docs, rows = sample
    path, own = encoding
    got = byte_bpe.encode_decode(docs, path, public_tokenizers.PATTERN, digests=True)
    texts = {r[0]: r[1] for r in rows}
    for r in got.collect():
        ids = np.array(own.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
        assert r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert byte_bpe.encode_decode(none, path, public_tokenizers.PATTERN).count() == 0
    assert set(queries.QUERIES) >= {"op1_pii", "op7_byte_bpe"}
