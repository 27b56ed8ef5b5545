import random
import time

import pytest
from pyspark.sql import functions as F

from provender.llm import licenses, quoting, secrets, walks


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 1000])
def test_running(spark, n):
    pick = random.Random(n)
    values = [pick.randrange(-5, 100) for _ in range(n)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    row = df.select(walks.running(F.col("v"), lambda a, b: a + b, 0).alias("s"), walks.running(F.col("v"), F.greatest, -9).alias("m")).first()
    assert row.s == [sum(values[:i]) for i in range(n)]
    assert row.m == [max([-9, *values[:i]]) for i in range(n)]


def test_runs(spark):
    for values, want in [([], []), ([1], [(0, 1)]), ([1, 1, 2, None, None, 1], [(0, 2), (2, 1), (3, 2), (5, 1)])]:
        df = spark.createDataFrame([(values,)], "v array<int>")
        found = walks.over_runs(walks.run_ends(F.col("v")), lambda a, n: F.struct(a.alias("a"), n.alias("n")))
        assert [tuple(r) for r in df.select(found.alias("r")).first().r] == want


@pytest.mark.parametrize("kind", ["secrets", "redacted", "quotes", "licenses"])
def test_time_goes_with_the_length_of_the_text(spark, kind):
    def took(n):
        text = {"quotes": lambda: "\n".join("> " * (i % 3) + f"line {i % 50}" for i in range(n)),
                "licenses": lambda: " ".join(["mit license general public license apache word"] * (n // 6))}.get(
            kind, lambda: " ".join(f"AKIA{i:016d}" for i in range(n)))()
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        found = secrets.found_in(F.col("text"))
        made = {"secrets": lambda: df.select(F.size(found)), "quotes": lambda: df.select(F.size(quoting.passages(F.col("text")))),
                "redacted": lambda: df.select(F.length(secrets.redacted(F.col("text"), found))),
                "licenses": lambda: licenses.scan_licenses(df).select(F.size("places"))}[kind]()
        start = time.perf_counter()
        size = made.first()[0]
        return time.perf_counter() - start, size

    took(100)
    short, a = took(10_000)
    long, b = took(40_000)
    assert 3.9 < b / a < 4.2 and long < 5 * short + 1


def test_redaction_of_long_texts(spark, tmp_path):
    key = "AKIA" + "Q" * 16
    text = "ä" * 3000 + f" {key} " + "é\n" * 700 + key + "," + "x" * 1023 + f"password={'z' * 14}" + "."
    row = secrets.scan_versions(spark.createDataFrame([(text,)], "text string"), str(tmp_path / "l")).select(
        secrets.redacted(F.col("text"), F.col("found")).alias("t"), "found").first()
    want, at = "", 0
    for s in sorted(row.found, key=lambda s: s.start):
        want, at = want + text[at:s.start] + "[secret]", s.end
    assert row.t == want + text[at:] and key not in row.t
