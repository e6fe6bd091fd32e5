"""The SQL of operators against the operators, on rows that tables rarely hold."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from snaphist.llm import ngram_join, oracles, quality_rules, substring_dedup, suffix_dedup


def rows():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdéfg#") for _ in range(rng.randint(1, 4)))
    line = lambda n: " ".join(word() for _ in range(n))
    shared = [line(n) for n in (14, 20, 60)]
    out = []
    for i in range(120):
        text = line(rng.randint(0, 40))
        if i % 3 == 0:
            text += "\n" + rng.choice(shared) + "\n" + line(5)
        if i % 10 == 9:
            text = out[rng.randrange(i)][1].upper()
        out.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", None])))
    return out + [(200, None, None, None), (201, "", "en", "a"), (202, "few words", "en", "a"), (203, "few  WORDS", "en", "a"),
                  (204, ("again " * 4 + "\n") * 400, "en", "b"), (205, "a\x00b " * 20, "en", "b"), (206, "x" * 60 + "é" * 60, "en", "b"), (207, "x" * 60, "en", "b")]


@pytest.mark.parametrize("sql,operator", [
    (oracles.SUBSTRING_SQL, lambda d: substring_dedup.dedup_substrings(d).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))),
    (oracles.BYTES_SQL, lambda d: suffix_dedup.dedup_bytes(d).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))),
    (oracles.JOIN_SQL, lambda d: ngram_join.near_duplicates(d).select("doc_id", "n_shingles", "component_id")),
    (oracles.RULES_SQL, lambda d: quality_rules.judge(d).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")),
], ids=["substrings", "bytes", "join", "rules"])
def test_sql_and_operator_agree(spark, sql, operator):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string")
    got = sorted(tuple(r) for r in operator(docs).collect())
    documents = docs.toArrow()  # noqa: F841 (DuckDB reads it by its name)
    con = duckdb.connect()
    con.register("documents", documents)
    assert sorted(con.execute(sql).fetchall()) == got
