"""Small tables for the document operators, with awkward rows."""

import random

import duckdb

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

# columns that clash with names used inside the operators
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, key string, node string, "
              "run long, ghost boolean, n_words long, n_hit long, items string, _hits string, words string, bands string, src long")


def rows(texts, first_id=0):
    """documents rows: (doc_id, text) or plain texts."""
    out = []
    for i, t in enumerate(texts):
        doc_id, text = t if isinstance(t, tuple) else (first_id + i, t)
        out.append((doc_id, text, ["en", "de", None][i % 3], [None, "s1", "s2", "s3"][i % 4], 7, -1, "k", "n", 5, True, 1, 2,
                    "x", "y", "w", "b", 3))
    return out


def docs(spark, texts, parts=3):
    return spark.createDataFrame(rows(texts), DOC_SCHEMA).repartition(parts)


def word_text(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def awkward(long_words=60_000):
    """Nulls, empty and wordless texts, ties, repeated rows, a very long text, odd characters."""
    rng = random.Random(5)
    long = word_text(rng, long_words, 5000)
    same = word_text(rng, 80)
    return [None, "", " ", "!!! ... ???", "one", "one two three", same, same, same.upper(), (None, same), (None, None),
            (3, "repeated row of text"), (3, "repeated row of text"), (3, "another with the same id"), long, long + " end",
            "日本語のテキスト と émigré Ünïcode ", "a" * 50_000, "1" * 5_000, "é" * 3000 + "@" * 50, "+" + "1 " * 2000, "x😀y \U0001F600"
            .encode("utf-16", "surrogatepass").decode("utf-16"), "\t\n\r", "tab\tseparated\nlines | and | bars"]


def duck(tables):
    """DuckDB with the given tables: name -> (columns with types, rows)."""
    con = duckdb.connect()
    for name, (cols, data) in tables.items():
        con.execute(f"create table {name} ({cols})")
        if data:
            con.executemany(f"insert into {name} values ({','.join('?' * len(data[0]))})", data)
    return con
