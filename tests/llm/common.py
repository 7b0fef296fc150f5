"""Brute-force helpers and awkward tables shared by the tests."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

LONG = " ".join(f"w{i % 997}x{i // 997}" for i in range(30_000))
TEXTS = [
    None, "", " \n\t ", "one", "two words", "same text here now", "same text here now", "Same TEXT here\nnow", LONG, LONG,
    "é\u3000ü 漢字 a\u00a0b \u2028x <|endoftext|> don't I'll  two  spaces \n\n\n tail ", "\x00\x1c odd \x7f",
    "line a b\nline a b\nline a b\nother line", "x" * 20_000, "1 " * 5_000,
]


def low(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def awkward(spark):
    """Null ids, repeated rows, empty and very long texts, columns named like the operators' own."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5]), (None, "no id"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"),
                     *[F.lit(7).alias(c) for c in ("key", "size", "shard", "n", "cid", "node", "score", "start", "spans", "base", "kept", "n_words", "rank", "body", "slot")])


def empty(spark):
    return awkward(spark).limit(0)
