"""Documents with every odd case, and plain Python versions of what the operators compute."""

from __future__ import annotations

import random
import re

from tests.conftest import SF001

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CLASHES = ("key", "tag", "h", "size", "row", "stats", "kept", "cls", "node", "part", "grp", "x", "copies", "uid", "shard")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, odd characters."""
    dice = random.Random(4)
    vocabulary = ["".join(dice.choice("abcdeé") for _ in range(dice.randint(1, 7))) for _ in range(400)]

    def prose(n: int, seed: int) -> str:
        d = random.Random(seed)
        return " ".join(d.choice(vocabulary) for _ in range(n))

    shared, base = prose(70, 1), prose(120, 2)
    near = base.split(" ")
    near[60] = "other"
    texts = [
        None, "", "   \n\t ", "one", "two words", base, base, " ".join(near), base.upper(), prose(40, 5) + " " + shared,
        shared + "\n" + prose(30, 6), "x" * 6000, prose(6000, 7), "line a b\nline a b\nline a b\nend", "§ ok 漢字 🙂 <|endoftext|> it's so\x1c \x85",
        "a a a a " * 40, prose(200, 8) + " ### $$$ %%% | & <b>", "́́ combining", shared, prose(55, 9), "ünïcödé " * 30,
    ]
    rows = [(i, t, ["en", "de", None][i % 3], ["src1", None, "src2"][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], rows[9], rows[9]]                                    # repeated rows
    rows += [(None, base + " tail", "en", "src1", 5), (None, "no id at all", None, None, None)]
    rows += [(100 + i, prose(80, 100 + i), "en", "src1", None) for i in range(30)]
    return [r + tuple(f"{c}{i}" for c in CLASHES) for i, r in enumerate(rows)]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def small_docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def rows_of(docs) -> list[tuple]:
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def last_id(i):
    return (1 << 63) - 1 if i is None else i


def removed_mask(sequences: list[tuple], window: int) -> list[bytearray]:
    """For each (id, sequence) which units a window covers that starts in a smaller id's sequence."""
    first: dict = {}
    for i, s in sequences:
        for p in range(len(s) - window + 1):
            k = s[p:p + window]
            first[k] = min(first.get(k, i), i)
    out = []
    for i, s in sequences:
        gone = bytearray(len(s))
        for p in range(len(s) - window + 1):
            if first[s[p:p + window]] < i:
                gone[p:p + window] = b"\1" * window
        out.append(gone)
    return out
