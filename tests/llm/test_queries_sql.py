"""The queries against their SQL, whole and on odd tables; the pipeline against brute force."""

from __future__ import annotations

import base64
import hashlib
from pathlib import Path

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry_points
from tallyhouse.llm import mixing, pii, quality_rules, simhash
from tallyhouse.llm.oracle import ORACLE_SQL
from tallyhouse.llm.queries import QUERIES
from tests.llm.conftest import SMALL
from tests.llm.test_first_operators import brute_components, brute_measures, brute_print


def expected(folder, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        if not Path(folder, f"{table}.parquet").exists():
            continue
        connection.execute(f"create view {table} as from '{folder}/{table}.parquet'")
    return connection.execute(ORACLE_SQL[name])


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_gives_what_its_sql_gives(spark, multiset, name):
    df = QUERIES[name](spark, SMALL)
    result = expected(SMALL, name)
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    rows = [tuple(r[names.index(c)] for c in df.columns) for r in result.fetchall()]
    assert multiset(df.collect()) == multiset(rows)


@pytest.mark.parametrize("name", ["op2_quality_rules", "op10_suffixes", "op13_shingle_join"])
def test_query_on_odd_documents(spark, odd, multiset, tmp_path, name):
    docs, _ = odd
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    docs.selectExpr("doc_id as conv_id", "doc_id as turn", "text as role", "text").toPandas().to_parquet(
        tmp_path / "conversations.parquet"
    )
    df = QUERIES[name](spark, str(tmp_path))
    result = expected(tmp_path, name)
    names = [c[0] for c in result.description]
    rows = [tuple(r[names.index(c)] for c in df.columns) for r in result.fetchall()]
    assert multiset(df.collect()) == multiset(rows)


def test_all_are_registered():
    found = entry_points.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in found}
    assert "pipeline" in found
    assert set(ORACLE_SQL) <= set(entry_points.oracle_sql())


def test_pipeline_stages(spark, sample, multiset):
    docs, rows = sample
    columns = docs.columns
    kept = corpus_pipeline.quality(spark, docs, SMALL)
    assert kept.columns == columns
    texts = {r[0]: r[1] for r in rows}
    good = {r.doc_id for r in quality_rules.ledger(docs).where(quality_rules.passes()).collect()}
    assert {r.doc_id for r in kept.collect()} == good
    for doc_id in good:
        n_words, _, _, _, n_repeat = brute_measures(texts[doc_id])
        assert n_words >= 20 and 100 * n_repeat <= 30 * n_words

    one = corpus_pipeline.near_duplicates(spark, kept, SMALL)
    assert one.columns == columns
    prints = {i: brute_print(texts[i]) for i in good}
    roots = brute_components(list(prints.values()))
    least = {}
    for i in sorted(good):
        least.setdefault(roots[prints[i]], i)
    assert {r.doc_id for r in one.collect()} == set(least.values())

    clean = corpus_pipeline.personal_data(spark, one, SMALL)
    assert clean.columns == columns
    spans = {r.doc_id: r.spans for r in pii.personal_data(one).collect()}
    cleaned = {}
    for r in clean.collect():
        text, at, out = texts[r.doc_id], 0, ""
        for s in spans[r.doc_id]:
            if s.start >= at:
                out += text[at : s.start] + f"[{pii.KINDS[s.kind].upper()}]"
            at = max(at, s.end)
        assert r.text == out + text[at:]
        cleaned[r.doc_id] = r.text

    mixed = corpus_pipeline.mixture(spark, clean, SMALL)
    assert mixed.columns == columns
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.mix(mixing.sized(clean)).collect()}
    words = {}
    for r in mixed.collect():
        assert cleaned[r.doc_id].startswith(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.encode().split())
    assert words == {i: t for i, (_, t) in taken.items() if t}

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    final = corpus_pipeline.tokens(spark, mixed, SMALL).collect()
    assert multiset((r.doc_id, bytes(r.ids), r.n_tokens, r.decoded_sha256) for r in final) == multiset(
        (
            r.doc_id,
            np.array(own.encode_ordinary(r.text), "<u4").tobytes(),
            len(own.encode_ordinary(r.text)),
            hashlib.sha256(r.text.encode()).hexdigest(),
        )
        for r in mixed.collect()
    )


def test_pipeline_runs_and_repeats(spark, multiset):
    once = corpus_pipeline.run(spark, SMALL).collect()
    assert once and multiset(once) == multiset(corpus_pipeline.run(spark, SMALL).collect())


def test_pipeline_on_odd_documents(spark, odd, none):
    docs, _ = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == odd[0].columns, name
        assert stage(spark, none, SMALL).count() == 0
    assert simhash.groups(docs).count() == docs.count()
    final = corpus_pipeline.tokens(spark, docs, SMALL)
    assert final.count() == docs.count() and corpus_pipeline.tokens(spark, none, SMALL).count() == 0
