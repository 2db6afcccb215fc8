import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from gridcast.llm import training_order
from gridcast.llm.common import tokenizer_path
from gridcast.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import DOCS, documents


def tables(spark, folder, texts, items, labels=()):
    docs = documents(spark, texts, lang=["en"] * len(texts))
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def corpus(n, seed=1):
    r = random.Random(seed)
    syll = ["the", "an", "in", "er", "on", "re", "ti", "sh", "ou", "ha"]
    return [" ".join("".join(r.choices(syll, k=r.randrange(2, 5))) for _ in range(r.randrange(30, 120))) for _ in range(n)]


def test_stages_do_what_their_operators_say(spark, tmp_path):
    texts = corpus(120)
    item = " ".join(corpus(1, seed=9)[0].split()[:20])
    texts += [texts[0], texts[1] + " extra", texts[2] + " " + item]          # 120-122: copy, near copy, contaminated
    texts += ["zqx jvk " * 60, None, ""]                                       # 123-125: junk and empty
    labels = [(i, 1, 0) for i in range(100)]
    docs = tables(spark, tmp_path, texts, [item], labels)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    q, s, d, m = (kept[name] for name, _ in corpus_pipeline.STAGES[:-1])
    ids = lambda rows: {i for i, _ in rows}
    assert 123 not in ids(q) and len(ids(q) & set(range(123))) >= 118
    # brute force: the least id of each component of what came in
    order = sorted(q)
    comp = brute.components([i for i, _ in order], [brute.simhash(t) for _, t in order])
    assert ids(s) == set(comp) and len(s) == len(ids(s)) and 120 not in ids(s)
    bad = {r[0] for r in brute.contamination(s, [(0, item)]) if r[-1]}
    assert ids(d) == ids(s) - bad and 122 in ids(q) and 122 not in ids(d)
    # the mix takes each source's target in whole texts but for one cut
    source = {i: (["a", "b", None] * 50)[i] for i in range(len(texts))}
    sizes, taken = Counter(), Counter()
    for i, t in d:
        sizes[source[i]] += len(brute.WORD.findall(t or ""))
    for i, t in m:
        taken[source[i]] += len(brute.WORD.findall(t or ""))
    for src, want in brute.targets(sizes).items():
        assert abs(taken[src] - want) <= 0.5 + 1e-6
    assert sum(t not in dict(d).values() for _, t in m) <= 3
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    bpe = training_order.encoding(tokenizer_path("byte_bpe_50k.tiktoken"))
    got = Counter(tuple(np.frombuffer(r.tokens, "<u2")[:r.n_tokens].tolist()) for r in rows if r.n_tokens < 1024 and r.seq_no == 0)
    assert got == Counter((*bpe.encode_ordinary(t or ""), bpe.n_vocab) for _, t in m)


def test_run_is_the_stages(spark, tmp_path):
    tables(spark, tmp_path, corpus(40), [" ".join(corpus(1, 7)[0].split()[:15])], [(i, 1, 0) for i in range(30)])
    rows = QUERIES["pipeline"](spark, str(tmp_path)).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows))) and len(rows) > 20


def test_odd_rows_and_empty_tables(spark, tmp_path):
    texts = [None, "", " ", "a b c", "a b c", "x" * 3000, "é漢 🙂 \n\n"]
    docs = documents(spark, texts, ids=[None, None, 3, 4, 4, 5, 6])
    docs.unionAll(docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} <= {4, 5, 6} and rows
    spark.createDataFrame([], DOCS).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_keep_one_of_equal_rows(spark):
    t = " ".join(f"w{i}" for i in range(50))
    docs = documents(spark, [t, t, t, "other words"], ids=[7, 7, None, 8])
    out = corpus_pipeline.near_duplicates(spark, docs.unionAll(docs), "")
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(7, t), (8, "other words")]
    assert out.columns[0] == "doc_id"
    one_null = corpus_pipeline.near_duplicates(spark, documents(spark, [t, t], ids=[None, None]), "")
    assert one_null.count() == 1


def test_columns_of_any_name_are_carried(spark, tmp_path):
    """Names that stages and operators use inside, dots, and a lone underscore."""
    names = ["_text_hash", "_id_hash", "_row_hash", "_", "a.b", "doc", "none", "row", "c0", "root", "fp", "id", "kept", "text_hash", "lid", "draws"]
    docs = tables(spark, tmp_path, corpus(60), [" ".join(corpus(1, 7)[0].split()[:15])], [(i, 1, 0) for i in range(40)])
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.lit("-"), F.col("doc_id")))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.mode("overwrite").parquet(f"{tmp_path}/clash-{i}")
        docs = spark.read.parquet(f"{tmp_path}/clash-{i}")
        rows = docs.collect()
        assert len(rows) > 30 and all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0
