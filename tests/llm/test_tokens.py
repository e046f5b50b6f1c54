"""Token counts and packing against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from framewright.llm import packing, token_counts
from framewright.llm.bpe import PreTokens, Table
from tests.llm import helpers

PATH = token_counts.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_pre_tokens_give_the_library_s_ids(library):
    pre, dice = PreTokens(PATH), random.Random(2)
    assert pre.plain and pre.ranks is not None
    settled = [chr(c) for c in range(0x110000) if not pre.unsettled.search(chr(c))]
    assert len(settled) > 50_000
    texts = ["a" + c + "1" + c + c + " " + c + "!" + c + "\n" + c + "  " + c + "'s" for c in settled]
    texts += ["".join(dice.choice(settled + [" ", "\n", "'ll", "  ", "<|endoftext|>"] * 40) for _ in range(60)) for _ in range(1500)]
    texts += [t for _, t in ((0, r[1]) for r in helpers.odd_rows()) if t]
    for text in texts:
        runs = pre.runs(text)
        ids = pre.whole_ids(text) if runs is None else [i for run in runs for t in run for i in pre.token_ids(t)]
        assert ids == library.encode(text, add_special_tokens=False).ids, text


SENTENCES = [
    "The quick brown fox, 12 times \u2014 \u201cwell\u201d\u2026 it's\u00a0done!", "Ti\u1ebfng Vi\u1ec7t c\u00f3 s\u00e1u thanh \u0111i\u1ec7u, ph\u1ea3i kh\u00f4ng?",
    "\u0647\u0630\u0647 \u062c\u0645\u0644\u0629 \u0628\u0627\u0644\u0644\u063a\u0629 \u0627\u0644\u0639\u0631\u0628\u064a\u0629\u060c \u0664\u0665 \u0643\u0644\u0645\u0629\u061f", "\u092f\u0939 \u0939\u093f\u0928\u094d\u0926\u0940 \u0915\u093e \u0935\u093e\u0915\u094d\u092f \u0939\u0948\u0964 \u0967\u0968\u0969",
    "\u8fd9\u662f\u4e00\u4e2a\u53e5\u5b50\uff0c\u300c\u5f15\u7528\u300d\u3002\uff11\uff12\uff13\uff21\uff22", "\u3053\u308c\u306f\u6587\u3067\u3059\u3002\u30c6\u30b9\u30c8\u3001\u30fc\u3002", "\ud55c\uad6d\uc5b4 \ubb38\uc7a5\uc785\ub2c8\ub2e4.  \ub450 \uce78",
    "\u042d\u0442\u043e \u043f\u0440\u0435\u0434\u043b\u043e\u0436\u0435\u043d\u0438\u0435 \u2116 5, \u044a\u0451", "\u05d6\u05d4 \u05de\u05e9\u05e4\u05d8 \u05d1\u05e2\u05d1\u05e8\u05d9\u05ea, \u05e9\u05c1\u05dc\u05d5\u05b9\u05dd", "\u0e19\u0e35\u0e48\u0e04\u0e37\u0e2d\u0e1b\u0e23\u0e30\u0e42\u0e22\u0e04\u0e20\u0e32\u0e29\u0e32\u0e44\u0e17\u0e22 \u0e51\u0e52",
    "\u0391\u03c5\u03c4\u03ae \u03b5\u03af\u03bd\u03b1\u03b9 \u03bc\u03b9\u03b1 \u03c0\u03c1\u03cc\u03c4\u03b1\u03c3\u03b7\u0387 \u20ac5 \u20b97", "ok \U0001f642\U0001f3fd \U0001f468\u200d\U0001f469\u200d\U0001f467 \u2764\ufe0f \U0001f1e9\U0001f1ea \U0001fae0\x1c\x0b\x85 end",
]


@pytest.mark.parametrize("text", SENTENCES)
def test_sentences_of_many_scripts_go_through_the_table(library, text):
    pre = PreTokens(PATH)
    runs = pre.runs(text * 3)
    assert runs is not None
    assert [i for run in runs for t in run for i in pre.token_ids(t)] == library.encode(text * 3, add_special_tokens=False).ids


def test_characters_of_late_unicode_versions_are_left_to_the_library(spark, library):
    text = "caf\u00e9 \u1c90\u1c91 \u0870 \U00010450 \U0001e900"
    assert PreTokens(PATH).runs(text) is None
    docs = spark.createDataFrame([(1, text), (2, SENTENCES[1])], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, PATH).collect()}
    assert got == {1: len(library.encode(text).ids), 2: len(library.encode(SENTENCES[1]).ids)}


def test_long_texts_are_matched_piecewise(library, monkeypatch):
    from framewright.llm import bpe
    monkeypatch.setattr(bpe, "LONG", 50)
    pre, text = PreTokens(PATH), "some longer text, 12 words or so, it's cut in runs " * 20
    assert [i for run in pre.runs(text) for t in run for i in pre.token_ids(t)] == library.encode(text, add_special_tokens=False).ids


def test_table_keeps_what_it_was_given():
    table = Table({"a": 1}, len, 3)
    assert [table[t] for t in ("a", "bb", "ccc", "dddd", "ee", "bb")] == [1, 2, 3, 4, 2, 2]
    assert table["a"] == 1 and len(table) <= 5


@pytest.mark.parametrize("docs", [helpers.odd_docs, helpers.small_docs])
def test_counts_equal_the_library_s(spark, library, docs):
    docs = docs(spark)
    want = Counter()
    for i, t in helpers.rows_of(docs):
        n = len(library.encode(t, add_special_tokens=False).ids)
        want[i, len(t.encode()), n, n > 1024] += 1
    assert Counter(map(tuple, token_counts.count_tokens(docs, PATH).collect())) == want


def test_no_documents(spark):
    assert token_counts.count_tokens(helpers.no_docs(spark), PATH).count() == 0
    assert packing.pack(helpers.no_docs(spark), PATH).count() == 0


@pytest.mark.parametrize("docs", [helpers.odd_docs, helpers.small_docs])
def test_packing_is_a_round_trip(spark, library, docs):
    docs = docs(spark)
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, PATH).collect():
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    texts = defaultdict(list)
    for i, t in helpers.rows_of(docs):
        texts[i].append(t)
    assert set(texts) == set(pieces)
    total = 0
    for i, each in texts.items():
        want = Counter()
        for t in each:
            ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
            total += len(ids)
            cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
            for k, (a, z) in enumerate(zip(cuts, cuts[1:])):
                want[k, a, z - a, zlib.crc32(ids[a:z].tobytes())] += 1
        assert Counter(pieces[i]) == want
    assert len(bins) <= -(-total // 1024) * 1.02 + 1


def test_crossover_keeps_every_piece_once():
    dice = random.Random(1)
    sizes = [dice.randint(1, 99) for _ in range(300)]
    a, b = packing.Packing(sizes, 100, []), packing.Packing(sizes, 100, [])
    a.best_fit(list(range(300)))
    b.best_fit(list(range(0, 300, 2)))
    b.best_fit(list(range(1, 300, 2)))
    for _ in range(20):
        child = packing.crossover(a, b, dice)
        assert sorted(i for bin_ in child.bins for i in bin_) == list(range(300))
        assert child.fills == [sum(sizes[i] for i in bin_) for bin_ in child.bins] and max(child.fills) <= 100
        a, b = b, child
    best = packing.evolve(sizes, 100, 0, [a.labels()])
    assert len(best.bins) <= len(a.bins) and packing.from_labels(sizes, 100, best.labels()).cost[0] == best.cost[0]


def test_rows_that_share_an_id_are_not_all_chosen(spark):
    rows = [(None, f"alone{i}") for i in range(4000)] + [(i, f"other{i}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = token_counts.frequent_lengths(docs, token_counts.tokenizer_path(), n_docs=80)
    assert seen and not {"alone", "other"} - {"".join(c for c in t if c.isalpha()) for t in seen}
    plan = []
    chosen = type(docs).mapInArrow
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(docs), "mapInArrow", lambda df, *a, **k: plan.append(df) or chosen(df, *a, **k))
        token_counts.frequent_lengths(docs, token_counts.tokenizer_path(), n_docs=80)
    assert 20 < plan[0].count() < 200 and plan[0].rdd.getNumPartitions() > 1
