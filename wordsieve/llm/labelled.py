"""Bounded samples of labelled texts, for models that are fitted on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordsieve.llm.common import quoted
from wordsieve.session import stored

# Bytes of text that a sample holds at most.
SAMPLE_BYTES = 24 << 20


# Parts into which drawn texts are dealt, to find how many of them fit.
PARTS = 4096


def sample(
    docs: DataFrame, labels: DataFrame, per_label: int, text: str = "text", most_bytes: int = SAMPLE_BYTES, most_rows: int | None = None
) -> tuple[pd.DataFrame, dict]:
    """(label, text) of about ``per_label`` texts of each label, and the rate at which each label was taken.

    ``labels`` has the (doc_id, label) that may be learned from; null labels and texts are left out, repeated pairs count
    once, and so do repeated texts of an id. Rows are taken by a seeded hash of their id, at the rate that the labels'
    counts ask for, so no row is ranked and the order of the input doesn't matter. Ids are drawn first and only the
    drawn texts move. When these hold more than ``most_bytes``, or are more than ``most_rows``, they are dealt into PARTS by a
    hash of id and text, and the first parts that fit are taken, of all labels alike; no text is cut. The driver never gets
    more than that. Labels are expected to be few; each is a row on the driver.
    """
    known = labels.select("doc_id", "label").where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).distinct()
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return pd.DataFrame({"label": [], "text": []}), {}
    if most_rows is not None:
        per_label = min(per_label, max(1, most_rows // len(counts)))
    rates = {k: min(1.0, per_label / n) for k, n in counts.items()}
    rate = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])[F.col("label")]
    drawn = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    ids = stored(known.withColumn("u", drawn / rate).where("u < 1"), "sample-ids")
    texts = docs.select(F.col("doc_id"), quoted(text).alias("text")).where(F.col("text").isNotNull())
    part = F.pmod(F.xxhash64(F.lit(4), "doc_id", "text"), F.lit(PARTS)).alias("part")
    rows = stored(texts.join(ids, "doc_id").select("doc_id", "label", "text", part).distinct(), "sample")
    sizes = {r.part: (r.n, r.b) for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).collect()}
    parts = many = held = 0
    while parts < PARTS:
        n, b = sizes.get(parts, (0, 0))
        many, held = many + n, held + b
        if held > most_bytes or most_rows is not None and many > most_rows:
            break
        parts += 1
    found = rows.where(F.col("part") < parts).toPandas()
    # Rows come back in any order; the order of training is that of the ids.
    found = found.sort_values(["doc_id", "text", "label"], ignore_index=True)
    return found[["label", "text"]], {k: r * parts / PARTS for k, r in rates.items()}
