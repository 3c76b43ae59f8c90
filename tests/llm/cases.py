"""Small tables with the awkward rows, and helpers to run queries over them."""

from __future__ import annotations

import os
import random

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

_RNG = random.Random(11)


def prose(n: int, seed: int = 0) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abdeginorstu") for _ in range(r.randint(2, 8))) for _ in range(n))


def awkward() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, shared passages."""
    shared = prose(60, 5)
    long = prose(6000, 9)
    changed = prose(300, 3).split(" ")
    changed[40] = changed[41] = "changed"
    rows = [
        (1, prose(300, 3), "en", "a"),
        (2, " ".join(changed), "en", "a"),
        (3, prose(300, 3), "en", "a"),
        (4, "", "en", "b"),
        (5, None, "en", "b"),
        (6, " \n\t ", None, None),
        (7, "one", "en", "a"),
        (8, "one two three", "en", None),
        (9, prose(30, 1) + " " + shared + " " + prose(30, 2), "en", "a"),
        (10, prose(20, 6) + " " + shared + " " + prose(50, 7), "en", "b"),
        (11, long, "en", "a"),
        (12, long + " tail", "en", "c"),
        (13, "same line of some words here\n" * 30 + "Same line of some words here", "en", "a"),
        (14, "same line of some words there\n\nanother line of many more words", "en", "a"),
        (15, "Mail jo.doe@mail1.example.com or +1 (988) 555-2485 at 10.0.0.255, card 4111 1111 1111 1111", "en", "c"),
        (16, "Zeilen mit Ü und ß é\nund 日本語 😀 a@b.c", "de", "c"),
        (17, "a b c  double  spaces <|endoftext|> #$%& ", "en", "c"),
        (2**40, prose(300, 3), "en", "a"),
    ]
    rows = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
    return [*rows, rows[8], rows[6]]


def write_tables(spark, path: str, rows: list[tuple], labels: list[tuple] | None = None) -> str:
    """A folder of Parquet tables as the queries read them; extra columns have awkward names."""
    docs = spark.createDataFrame(rows, SCHEMA)
    for extra in ("score", "size", "host", "id", "line", "key", "node", "part", "shard"):
        docs = docs.selectExpr("*", f"'x' as {extra}")
    docs.write.mode("overwrite").parquet(os.path.join(path, "documents.parquet"))
    labels = labels if labels is not None else [(r[0], i % 2, 0) for i, r in enumerate(rows)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(os.path.join(path, "labels.parquet"))
    return path


def small_documents() -> list[tuple]:
    import duckdb

    return duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet' order by doc_id").fetchall()


def pairs(rows: list[tuple]) -> list[tuple]:
    return [(r[0], r[1]) for r in rows]
