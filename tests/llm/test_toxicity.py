import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.compression import learn_toxicity, toxicity
from tidemark.llm.frames import bounded
from tidemark.llm.queries import op9_compression_toxicity


def test_odd_rows(spark):
    pick = random.Random(4)
    plain = [f"{a}{b}" for a in ("lor", "ip", "dol", "sit", "am") for b in ("em", "sum", "or", "et", "is")]
    rows, labels = [], []
    for i in range(120):
        words = pick.choices(plain, k=120)
        if i % 3 == 0:
            for k in range(0, 120, 12):
                words[k] = pick.choice(["horrible", "nasty", "vile"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    rows += [(500, None), (501, ""), (None, "nasty vile horrible"), (502, rows[0][1] * 200), (0, rows[0][1])]
    labels += [(None, 1), (501, None), (3, 0), (500, 1), (502, 1)]
    docs = bounded(spark).createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = learn_toxicity(docs, marks)
    found = [(r.doc_id, r.s) for r in docs.select("doc_id", toxicity("text", model).alias("s")).collect()]
    assert len(found) == len(rows) and all(0 <= s <= 1 for _, s in found)
    right = [(s >= 0.5) == (i % 3 == 0) for i, s in found if i is not None and i < 120]
    assert np.mean(right) > 0.9
    assert learn_toxicity(docs.limit(0), marks) is None
    assert {r.s for r in docs.select(toxicity("text", None).alias("s")).collect()} == {0.0}


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    found = op9_compression_toxicity(spark, sf).where("held_out")
    pairs = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("toxic is not null")
    rows = pairs.select("score", "predicted", "toxic").toPandas()
    ranks = rows["score"].rank()
    pos = rows["toxic"] == 1
    auc = (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    recall, precision = (rows["predicted"][pos] == 1).mean(), (rows["toxic"][rows["predicted"] == 1] == 1).mean()
    print(f"auc {auc:.3f} recall {recall:.3f} precision {precision:.3f}")
    assert auc > 0.85
