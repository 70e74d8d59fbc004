"""Merkle trees, suffix-tree scores, token files, chat formatting and repeats against brute force."""

from __future__ import annotations

import contextlib
import hashlib
import math
import re
import threading
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import chat_format, merkle, queries, suffix_tree, suffixes, token_files


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


# Merkle


@pytest.mark.parametrize("rows_each", [4096, 5])
def test_merkle(corpus, multiset, rows_each):
    docs, rows = corpus
    order = in_order(rows)
    expected, near = [], {}
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 2
        edited = text[: len(text) - k] + after[:k]
        expected.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest()))
        near[hashlib.sha256(edited.encode()).hexdigest()] = (text, edited, after)
    got = merkle.fingerprints(docs, rows_each).collect()
    assert multiset(r[:3] for r in got) == multiset(expected)
    for r in got:
        text, edited, after = near[r.edited_sha256]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (r.edit_at is None)
        if r.edit_at is not None and text != edited:
            a, b = text.encode(), edited.encode()
            assert a[: r.edit_at] == b[: r.edit_at]
        if len(text) > 3000 and text != edited:
            assert r.near_edited > 0.3
    by_text = {}
    for text in {r[1] or "" for r in rows}:
        by_text.setdefault(merkle.Tree(text.encode()).root, []).append(text)
    assert all(len(x) == 1 for x in by_text.values())
    assert {r.fingerprint for r in got} == set(by_text)


def test_merkle_small_tables(spark, none):
    assert merkle.fingerprints(none).count() == 0
    (one,) = merkle.fingerprints(
        spark.createDataFrame([(7, "alone")], "doc_id long, text string")
    ).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"aloal").hexdigest()


def test_leaves_cover_the_text():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 4, 31, 500, 5000):
        text = bytes(rng.choice([10, 32, 65, 66, 200], n).astype(np.uint8))
        edges = merkle.leaf_edges(text)
        assert edges == sorted(set(edges)) and (edges[-1:] == [n] if n else edges == [])


# Suffix tree


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*WORDS.findall(lowered), None]


def brute_base(rows):
    counts, n = Counter(), 0
    for r in rows:
        if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2:
            tokens = brute_tokens(r[1])
            counts.update(tokens)
            n += len(tokens)
    v = len(counts)
    out = []
    for r in rows:
        tokens = brute_tokens(r[1])
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        known = sum(counts[t] > 0 for t in tokens)
        held = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2
        out.append((r[0], held, len(tokens), known, n, round(score, 6)))
    return out


def test_suffix_tree_base(corpus, multiset):
    docs, rows = corpus
    got = suffix_tree.scores(docs, share=1e-4).collect()
    assert multiset((*r[:5], round(r.base_score, 6)) for r in got) == multiset(brute_base(rows))
    assert all(r.score <= 0 for r in got)


def test_suffix_tree_predicts_better(sample):
    docs, _ = sample
    got = [r for r in suffix_tree.scores(docs, share=1e-4).collect() if r.held_out]
    assert len(got) > 10
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def brute_tree(rows, depth, least=2):
    """Scores by a tree in dictionaries, contexts of up to ``depth`` words."""
    texts = [(zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2, brute_tokens(t)) for i, t in rows]
    seen = [Counter() for _ in range(depth + 1)]
    for trained, words in texts:
        for k in range(depth + 1):
            if trained:
                seen[k].update(tuple(words[i : i + k + 1]) for i in range(len(words) - k))
    n, v = sum(seen[0].values()), len(seen[0])
    nodes = {}

    def chance(context, word):
        if not context:
            return (seen[0][(word,)] + 1) / (n + v + 1)
        below = chance(context[1:], word)
        node = nodes.get(context)
        return below if node is None else node[0].get(word, 0) + node[1] * below

    for k in range(1, depth + 1):
        after = {}
        for string, c in seen[k].items():
            if c >= least:
                after.setdefault(string[:-1], {})[string[-1]] = c
        grown = {}
        for context, symbols in after.items():
            total = seen[k - 1][context]
            low = {w: chance(context[1:], w) for w in symbols}
            gain = sum(c / total * math.log(c / total / low[w]) for w, c in symbols.items())
            left, low_left = 1 - sum(symbols.values()) / total, 1 - sum(low.values())
            if left > 1e-12 and low_left > 1e-12:
                gain += left * math.log(left / low_left)
            if gain * total > suffix_tree.DIVERGENCE:
                own = {w: (c - suffix_tree.DISCOUNT) / total for w, c in symbols.items()}
                grown[context] = own, max(0, 1 - sum(own.values()))
        nodes.update(grown)
    return [
        (r[0], sum(math.log10(chance(tuple(words[max(0, i - depth) : i]), w)) for i, w in enumerate(words)))
        for r, (_, words) in zip(rows, texts, strict=True)
    ]


@pytest.mark.parametrize("depth, hot", [(2, 1_000_000), (3, 40)])
def test_suffix_tree_scores(corpus, depth, hot):
    docs, rows = corpus
    got = suffix_tree.scores(docs, depth=depth, hot=hot).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    got = sorted(((r.doc_id, r.score) for r in got), key=key)
    expected = sorted(brute_tree([r[:2] for r in rows], depth), key=key)
    assert [g[0] for g in got] == [e[0] for e in expected]
    assert [g[1] for g in got] == pytest.approx([e[1] for e in expected], rel=1e-6, abs=1e-6)


def test_suffix_tree_keeps_rare_contexts_of_a_large_corpus(spark):
    ids = [i for i in range(100) if not suffix_tree.held_out(i)]
    rare = " ".join(f"q{i} z{i}" for i in range(50))
    texts = [rare] * 3 + ["x " * 1_000_000] * 4
    docs = spark.createDataFrame(list(zip(ids, texts, strict=False)), "doc_id long, text string")
    got = [r for r in suffix_tree.scores(docs).collect() if r.n_tokens == 101]
    assert len(got) == 3 and all(r.train_tokens > 4_000_000 for r in got)
    # By words alone each of the 101 tokens costs about six digits; after its context, less than one.
    assert all(r.base_score < -500 and r.score > -100 for r in got)


def test_suffix_tree_sums_to_one(spark):
    texts = ["a b a b a c", "a b a b", "c c a b a", "b a b a b", "a c b a b"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    counted = suffix_tree.word_counts(suffix_tree.cut_blocks(docs, exchange=False), 8)
    model = suffix_tree.learn(docs, counted, 0.001)
    assert set(model.numbers) == {b"a", b"b", b"c", suffix_tree.END}
    assert model.levels[0].retained.any() and model.levels[1].retained.any()
    words = np.arange(4)
    count = Counter()
    for i, t in enumerate(texts):
        if not suffix_tree.held_out(i):
            count.update([w.encode() for w in t.split()] + [suffix_tree.END])
    names = sorted(model.numbers, key=model.numbers.get)
    root = np.array([count[w] + 1 for w in names]) / (model.tokens + model.distinct + 1)
    unknown = 1 / (model.tokens + model.distinct + 1)
    for context in range(4):
        at = np.full(4, context)
        one = suffix_tree._chance(model.levels[0], at, words, root)
        rest = suffix_tree._chance(
            model.levels[0], at[:1], np.array([-1]), np.array([unknown])
        )
        assert one.sum() + rest[0] == pytest.approx(1)
    for pair in range(len(model.pairs)):
        at = np.full(4, model.pairs[pair] % suffix_tree.SHIFT)
        one = suffix_tree._chance(model.levels[0], at, words, root)
        low = suffix_tree._chance(model.levels[0], at[:1], np.array([-1]), np.array([unknown]))
        two = suffix_tree._chance(model.levels[1], np.full(4, pair), words, one)
        rest = suffix_tree._chance(model.levels[1], np.array([pair]), np.array([-1]), low)
        assert two.sum() + rest[0] == pytest.approx(1)


def test_suffix_tree_small_tables(spark, none):
    assert suffix_tree.scores(none).count() == 0
    held = next(i for i in range(100) if suffix_tree.held_out(i))
    (r,) = suffix_tree.scores(
        spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    ).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_pair_contexts():
    found = suffix_tree.sequence([b"a b c", b"", b"", b"B a"])
    number = found.numbers
    assert list(suffix_tree._before(number, found, 1)) == [-1, 1, 2, 3, -1, -1, -1, 2, 1]
    assert list(suffix_tree._before(number, found, 2)) == [-1, -1, 1, 2, -1, -1, -1, -1, 2]


def test_sequence_splits_at_the_six_characters():
    every = bytes(range(256))
    for texts in ([], [b""], [b"", b" ", b"\n a\t", b"x"], [every, b"A b", every[::-1]], ["É x\x85y \x1c".encode(), b"a \xff"]):
        known, numbers, ends = {b"\n": 0}, [], []
        for text in texts:
            numbers += [known.setdefault(w, len(known)) for w in text.lower().split()] + [0]
            ends.append(len(numbers))
        found = suffix_tree.sequence(texts)
        assert (found.words, found.numbers.tolist(), found.ends.tolist()) == (list(known), numbers, ends)


@pytest.mark.parametrize("top", [1, 3, 1000, 1 << 40, 1 << 62])
def test_ranks_and_different_keys(top):
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5, 1000):
        keys = np.append(rng.integers(0, top, n), [top - 1] * (n > 1))
        ordered, places = suffix_tree.ranked(keys)
        assert list(places) == list(np.argsort(keys, kind="stable"))
        assert list(ordered) == sorted(keys)
        unique, which = np.unique(keys, return_inverse=True)
        found, own = suffix_tree.different(keys)
        assert list(found) == list(unique) and list(own) == list(which)


def test_levels_sort_without_places(monkeypatch):
    """Sorting places by key took most of a level's time: where keys and places fit into one number,
    they are sorted together."""
    walk = suffix_tree.Walk(
        ends=np.array([4, 8]), trained=np.ones(8, bool), words=np.array([5, 0, 9]), index=np.array([1, 2, 1, 0] * 2),
        place=np.array([1, 2, 1, 0] * 2), number=np.array([5, 0, 9]), n=np.array([2, 4, 2]), below=np.full(8, 0.25),
    )
    for name in ("unique", "argsort", "lexsort"):
        real = getattr(np, name)
        monkeypatch.setattr(np, name, lambda x, *a, real=real, **k: real(x, *a, **k) if len(x) < 3 else 1 / 0)
    asked = suffix_tree.question(walk, 2, 4, 1_000_000)
    assert sorted(asked.units) == [1, 2]
    assert list(asked.before) == [-1, 1, 2, 1] * 2
    assert list(asked.context) == [1, 1, 2]


# Token files


@pytest.fixture(scope="module")
def tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


@pytest.mark.parametrize("options", [{}, {"rows_each": 6, "file_ids": 700}])
def test_token_files(corpus, multiset, tokenizer, options):
    docs, rows = corpus
    path, own = tokenizer
    expected, start = [], 0
    for r in in_order(rows):
        ids = [*own.encode(r[1] or "", add_special_tokens=False).ids, 2]
        expected.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    files = token_files.written(docs, path, **options)
    assert multiset(token_files.read_documents(files).collect()) == multiset(expected)


def test_names_of_added_tokens_are_those_tokens(spark, tokenizer):
    path, own = tokenizer
    end = "<|endoftext|>"
    texts = [end, f"{end}x", f"x {end}", f"x {end} y", f"a{end}{end}\n b", f"{end} {end} ", "<|endoftext", f"<{end}>"]
    found = token_files.encode_texts([*texts, "plain  text", *texts], path)
    wanted = [own.encode(t, add_special_tokens=False).ids for t in [*texts, "plain  text", *texts]]
    assert [list(x) for x in found] == wanted
    assert list(found[3]) == [87, 220, 50256, 331]


class Counting:
    """A tokenizer that counts the texts its library is asked to encode."""

    def __init__(self, own):
        self.own, self.asked = own, 0

    def __getattr__(self, name):
        return getattr(self.own, name)

    def encode_batch(self, texts, **options):
        self.asked += len(texts)
        return self.own.encode_batch(texts, **options)

    def encode_batch_fast(self, texts, **options):
        self.asked += len(texts)
        return self.own.encode_batch_fast(texts, **options)


def test_new_pieces_are_encoded_together(monkeypatch, tokenizer):
    path, own = tokenizer
    counting = Counting(own)
    monkeypatch.setattr(Tokenizer, "from_file", lambda _: counting)
    texts = [" ".join(f"{i * j}-й\nслово{i + j}, {i}." for i in range(50)) for j in range(20)]
    alias = f"{path[:-5]}/../{path.rsplit('/', 1)[1]}"  # not cached yet
    found = token_files.encode_texts(texts, alias)
    assert [list(x) for x in found] == [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert counting.asked < 50


@pytest.mark.parametrize("most", [0, 10, 800_000])
def test_pieces_of_any_form(monkeypatch, tokenizer, most):
    path, own = tokenizer
    monkeypatch.setattr(token_files, "REMEMBERED", most)
    monkeypatch.setattr(token_files, "TOGETHER", 3)
    parts = ["a", "we'll", "it's,", "été.", "\n", " ", "\t", "x\0y", "\0", "日本", "e\u0301", "\xa0", "\u2003", "\x1c", "12", "3rd"]
    parts += ["''", "--", "Ġ", "Ċ", "\r\n", "<|endoftext", "😀", "\u200b", "s'", "?!", "'re", "_", "don't.", "A", "ÿ", "×", "\x85"]
    rng = np.random.default_rng(7)
    texts = ["", " ", "\n", "\n\n", "\n a", "a\n", "  a", "\na", "\n\na", " ,", "\n,", "a \nb", "a\n b", "word", "word,", " word"]
    for _ in range(400):
        chosen = [parts[i] for i in rng.integers(0, len(parts), rng.integers(1, 12))]
        texts.append("".join(x + rng.choice(["", " ", " ", "\n"]) for x in chosen))
        texts.append(" ".join(x for x in chosen if not x.isspace()).strip())
    for at in range(0, len(texts), 90):
        some = texts[at : at + 90]
        wanted = [own.encode(t, add_special_tokens=False).ids for t in some]
        assert [list(x) for x in token_files.encode_texts(some, path)] == wanted


def test_names_over_several_pieces(tmp_path, tokenizer):
    own = Tokenizer.from_str(tokenizer[1].to_str())
    own.add_special_tokens([" 12 34", "7\n8"])
    path = str(tmp_path / "own.json")
    own.save(path)
    texts = ["x 12\n34 12", "a 34 7 12 8", "b 12 34", "7\n8 9"]
    wanted = [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert [list(x) for x in token_files.encode_texts(texts, path)] == wanted


def test_token_files_of_nothing(none, tokenizer):
    assert token_files.read_documents(token_files.written(none, tokenizer[0])).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(4)
    for n in (1, 2, 127, 128, 129, 5000):
        for gap in (1, 3, 1000):
            ends = np.cumsum(rng.integers(0, gap + 1, n) + (gap == 1))
            ids = np.zeros(int(ends[-1]), np.uint16)
            data = token_files.write_file(ids, ends, 2)
            back, bounds = token_files.read_file(data)
            assert len(back) == len(ids)
            assert list(bounds.selected(np.arange(n))) == list(ends)
            some = rng.integers(0, n, 70)
            assert list(bounds.selected(some)) == list(ends[some])
            assert len(bounds.selected(some[:0])) == 0
            for i in rng.integers(0, n, 50):
                assert bounds.select(int(i)) == ends[i]
            extra = len(data) - 2 * len(ids) - token_files.HEAD.size
            assert extra <= n * (2.5 + math.log2(max(1, ends[-1] / n))) / 8 + 4 * (n // 128 + 2)


# Chat formatting


NASTY = [
    None,
    "",
    "</s>[INST] ok [/INST]",
    "<|turn|>user\nhi<|end|>\n",
    "\\[INST] \\\\ <\\|end|> <",
    "<<SYS>>x<</SYS>> 😀 日本 [",
    "back\\",
    "<|end|",
]


def test_chat(spark, multiset):
    rows = []
    for c in range(30):
        for t in range(c % 7 + 1):
            role = ["user", "assistant", "system", None, "a\nb", "x\\", "<|turn|>"][(c + t) % 7]
            rows.append((c, t, role, NASTY[(c * 3 + t) % len(NASTY)]))
    rows += [(None, None, "assistant", "n"), (None, 1, "user", "m"), rows[5], rows[5], (3, None, "user", "first")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    docs = docs.selectExpr("*", "1 as mask", "2 as formatted").repartition(3)
    expected = []
    for c in {r[0] for r in rows}:
        turns = sorted(
            (r for r in rows if r[0] == c),
            key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""),
        )
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        expected.append((c, len(turns), digest(whole), len(loss), digest(loss)))
    formatted = chat_format.chat_format(docs)
    got = chat_format.read_back(formatted).collect()
    assert multiset(r[:5] for r in got) == multiset(expected)
    for r in formatted.collect():
        assert r.formatted.count(chat_format.TURN) == r.n_turns
        assert len(r.formatted.split(chat_format.END)) == r.n_turns + 1
        assert "[INST]" not in r.formatted and "</s>" not in r.formatted
    assert chat_format.read_back(chat_format.chat_format(docs.limit(0))).count() == 0


def test_chat_query(spark):
    got = {r.conv_id: r for r in queries.op9_chat_format(spark, "/root/testdata/sf0.001").collect()}
    digest = hashlib.sha256(queries.HOSTILE.encode()).hexdigest()
    assert (got[-1].n_turns, got[-1].loss_chars, got[-1].loss_sha256) == (2, 21, digest)


def test_assemble():
    rng = np.random.default_rng(6)
    pieces = [bytes(rng.integers(0, 255, rng.integers(0, 9)).astype(np.uint8)) for _ in range(9000)]
    buffer, offsets = chat_format.assemble(pieces)
    assert buffer.tobytes() == b"".join(pieces)
    assert list(np.diff(offsets)) == list(map(len, pieces))


# Repeats


def brute_repeats(rows, length=100):
    seen, out = set(), []
    for r in in_order(rows):
        text = (r[1] or "").encode()
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            part = text[i : i + length]
            if part in seen:
                gone[i : i + length] = True
            seen.add(part)
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        out.append((r[0], len(text), int(gone.sum()), spans, bytearray(kept)))
    return out


@pytest.mark.parametrize("options", [{}, {"rows_each": 4, "rows_a_bucket": 1}])
def test_repeats(corpus, multiset, options):
    docs, rows = corpus
    got = suffixes.without_repeats(docs, **options).collect()
    assert multiset(got) == multiset(brute_repeats(rows))
    assert sum(r.n_removed for r in got) > 0


def test_repeats_of_nothing(none):
    assert suffixes.without_repeats(none).count() == 0


@pytest.mark.parametrize("turns", [1, 3])
def test_repeats_in_turns(odd, multiset, turns):
    docs, rows = odd
    got = suffixes.without_repeats(docs, rows_each=4, rows_a_bucket=1, turns=turns).collect()
    assert multiset(got) == multiset(brute_repeats(rows))


def test_repeats_hold_one_step_on_disk(spark, multiset):
    rng = np.random.default_rng(8)
    texts = [bytes(rng.integers(97, 123, 2000).astype(np.uint8)).decode() for _ in range(200)]
    rows = [(i, texts[i % 200]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = list(manager.localDirsString())

    def shuffled():
        sizes = {}
        for file in [x for d in folders for x in Path(d).rglob("shuffle_*.data")]:
            with contextlib.suppress(FileNotFoundError):
                sizes[file] = file.stat().st_size
        return sizes

    before, most, over = shuffled(), [0], threading.Event()

    def watch():
        while not over.wait(0.02):
            most.append(sum(size for x, size in shuffled().items() if x not in before))

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        found = suffixes.without_repeats(docs, rows_each=50)
        time.sleep(1)
        left = most[-1]
        got = found.collect()
    finally:
        over.set()
        watcher.join()
    assert multiset(got) == multiset(brute_repeats(rows))
    whole = sum(len(text) for _, text in rows)
    assert left < whole / 10, "files of finished steps stay"
    assert 0 < max(most) < 4 * whole, "one step holds the keys of all buckets"
    assert multiset(found.collect()) == multiset(got)


def test_cover():
    members = suffixes.COVER
    apart = {(a - b) % suffixes.PERIOD for a in members for b in members}
    assert len(apart) == suffixes.PERIOD


def test_a_string_column_that_is_too_large_raises(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "MOST_BYTES", 20)
    with pytest.raises(OverflowError):
        chat_format._formatted([1], [b"user"], [b"a text of more than twenty bytes"])
