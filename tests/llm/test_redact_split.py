"""Redaction shuffles only texts that may have found spans."""

from flowlens.functions import bloom
from flowlens.llm import pii
from pyspark.sql import functions as F


def test_texts_without_found_spans_are_not_joined(spark, monkeypatch):
    known = [(n, f"please write to user{n}@mail.example.org for details, doc {n}") for n in range(20)]
    new = [(50, "please write to hidden(at)example for details, doc x"), (None, "elsewhere hidden(at)example appears"), (50, "please write to hidden(at)example for details, doc x")]
    plain = [(100 + n, f"nothing to see in text {n}") for n in range(300)] + [(None, None), (None, ""), (50, None)]
    seen, whole = [], bloom.marked
    monkeypatch.setattr(bloom, "marked", lambda *args: (seen.append((whole(*args), args[-1])), seen[-1][0])[1])
    src = spark.createDataFrame(known + new + plain, "doc_id long, text string").withColumn("_block", F.lit(7)).withColumn("pii_may", F.lit("x"))
    out = pii.redact(src)
    assert out.columns == src.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "", r.pii_may) for r in out.collect())
    text = {t: "please write to [EMAIL] for details, doc x" if i == 50 else "elsewhere [EMAIL] appears" for i, t in new}
    want = [(i, f"please write to [EMAIL] for details, doc {i}") for i, _ in known] + [(i, text[t]) for i, t in new] + plain
    assert got == sorted((i is None, i or 0, t is None, t or "", "x") for i, t in want)
    rows, name = seen[0]
    assert rows.count() == len(want) and 3 <= rows.where(F.col(name)).count() < 30
