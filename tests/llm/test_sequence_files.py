"""Token ids in Arrow files of equal-length sequences."""

import os
import tempfile
import zlib

import numpy as np
from tokenizers import Tokenizer

from framewright.llm import sequence_files as sf
from framewright.llm.token_counts import tokenizer_path
from tests.llm.helpers import last_id, no_docs, odd_docs, small_docs


def expected(docs) -> list[tuple]:
    """By the library: ids of every document with the end id, in ascending order of id."""
    library = Tokenizer.from_file(tokenizer_path())
    out, at = [], 0
    for i, text in sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()), key=lambda r: last_id(r[0])):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def found(df) -> list[tuple]:
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()]


def test_small_table_equals_the_library(spark):
    docs = small_docs(spark)
    assert sorted(found(sf.token_files(docs, tokenizer_path()))) == sorted(expected(docs))


def test_odd_documents(spark):
    docs = odd_docs(spark)
    got, want = found(sf.token_files(docs, tokenizer_path())), expected(docs)
    # Rows that share an id may stand in any order among themselves: their ids and places are compared apart.
    assert sorted((last_id(i), n, c) for i, _, n, c in got) == sorted((last_id(i), n, c) for i, _, n, c in want)
    at = 0
    for i, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    assert [last_id(r[0]) for r in sorted(got, key=lambda r: r[1])] == sorted(last_id(r[0]) for r in want)


def test_no_documents(spark):
    df = sf.token_files(no_docs(spark), tokenizer_path())
    assert df.collect() == [] and df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_files_hold_equal_sequences_and_masks(spark):
    docs = small_docs(spark)
    folder = tempfile.mkdtemp(prefix="sequences-")
    files = sf.write_sequences(docs, tokenizer_path(), folder, length=64, batch=8, file_bytes=1 << 16).orderBy("part").collect()
    assert len(files) > 1
    total = 0
    for f in files:
        file = sf.SequenceFile(f.path)
        rows = [file.sequence(i) for i in range(len(file))]
        assert all(len(ids) == len(mask) == 64 for ids, mask in rows)
        mask = np.concatenate([m for _, m in rows])
        assert mask.sum() == f.n_ids and (mask[:f.n_ids] == 1).all() and len(rows) == -(-f.n_ids // 64)
        flat = np.concatenate([i for i, _ in rows])[:f.n_ids]
        assert (np.concatenate(list(file.ids(0, f.n_ids))) == flat).all()
        assert sum(1 for _ in file.documents()) == f.n_docs
        total += f.n_ids
    assert total == sum(n for _, _, n, _ in expected(docs))


def test_sequences_are_views_of_the_file():
    path = os.path.join(tempfile.mkdtemp(prefix="sequences-"), "one")
    w = sf.SequenceWriter(path, np.dtype("<u2"), length=16, batch=4)
    w.add(5, np.arange(100, dtype="<u4"))
    w.add(None, np.arange(1000, 1030, dtype="<u4"))
    w.close()
    file = sf.SequenceFile(path)
    ids, mask = file.sequence(6)
    assert not ids.flags.owndata and not mask.flags.owndata and not ids.flags.writeable
    assert ids.tolist() == [96, 97, 98, 99, *range(1000, 1012)]
    assert file.sequence(8)[1].tolist() == [1, 1] + [0] * 14
    assert list(file.documents()) == [(5, 0, 100), (None, 100, 30)]
    assert np.concatenate(list(file.ids(60, 50))).tolist() == [*range(60, 100), *range(1000, 1010)]


def test_rows_that_share_an_id_are_spread(spark):
    """A third of the rows without id: no file holds more than a few times its share."""
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) AS doc_id", "repeat(concat('word ', id, ' '), 120) AS text")
    folder = tempfile.mkdtemp(prefix="sequences-")
    files = sf.write_sequences(docs, tokenizer_path(), folder, file_bytes=1 << 18).collect()
    assert len(files) >= 6
    assert max(f.n_docs for f in files) < 3 * 3000 / len(files)
    assert sum(f.n_docs for f in files) == 3000
