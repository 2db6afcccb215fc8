import numpy as np
import public_tokenizers
import pytest

from gridcast.llm import training_order as to
from tests.llm.conftest import documents, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation_is_a_bijection(n):
    a = to.permute(np.arange(n), n, 1)
    assert sorted(a.tolist()) == list(range(n))
    if n >= 1000:
        assert a.tolist() != to.permute(np.arange(n), n, 2).tolist()
        assert abs(np.corrcoef(np.arange(n), a)[0, 1]) < 0.1


def ids(rows):
    return np.concatenate([np.frombuffer(r.tokens, "<u2")[:r.n_tokens] for r in sorted(rows, key=lambda r: r.seq_no)]).tolist()


def test_round_trip(spark):
    bpe = to.encoding(PATH)
    texts = odd_texts() + ["word " * 3000]
    rows = to.training_order(documents(spark, texts).repartition(3), PATH, seq_len=64, shard_len=10).collect()
    n = len(rows)
    assert sorted(r.slot for r in rows) == list(range(n))
    for r in rows:
        assert (r.shard, r.offset, len(r.tokens)) == (r.slot // 10, r.slot % 10 * to.stride(64), 128)
    for i, t in enumerate(texts):
        assert ids([r for r in rows if r.doc_id == i]) == [*bpe.encode_ordinary(t or ""), bpe.n_vocab]


def test_shards_are_partitions_in_slot_order(spark):
    df = to.training_order(documents(spark, ["some words here"] * 50), PATH, seq_len=16, shard_len=8)
    parts = df.rdd.mapPartitions(lambda it: [[r.slot for r in it]]).collect()
    assert [x for p in parts for x in p] == list(range(50)) and len(parts) == 7


def test_written_shards_resume_and_read_on(spark, tmp_path):
    df = to.training_order(documents(spark, [f"text {i} " * i for i in range(60)]), PATH, seq_len=32, shard_len=8).persist()
    want = [(r.slot, r.tokens) for r in df.orderBy("slot").collect()]
    path = str(tmp_path / "shards")
    to.write_shards(df.filter("shard < 3"), path, seq_len=32, shard_len=8)  # a run that broke off
    assert to.written_shards(spark, path) == [0, 1, 2]
    to.write_shards(df, path, seq_len=32, shard_len=8)
    assert sorted((r.slot, r.tokens) for r in to.read_from(spark, path, 0, 8, 32).collect()) == want
    assert sorted((r.slot, r.tokens) for r in to.read_from(spark, path, 21, 8, 32).collect()) == want[21:]
    for slot in (0, 5, 8, 21, len(want) - 1, len(want)):
        got = [r["ids"].tobytes() for r in to.sequences_from(path, slot, 8, 32)]
        assert got == [bytes(t) for _, t in want[slot:]]


def test_shards_are_raw_files_of_fixed_stride(spark, tmp_path):
    """All 65,536 values of an id, null and hashed ids come back from their places."""
    grid = np.arange(1 << 16, dtype="<u2").reshape(-1, 64)
    rows = [(s, s // 100, s % 100 * to.stride(64), None if s % 5 == 0 else f"id {s}", s % 3, 64, grid[s].tobytes()) for s in range(len(grid))]
    df = spark.createDataFrame(rows, "slot long, shard int, offset long, doc_id string, seq_no int, n_tokens int, tokens binary")
    path = str(tmp_path / "shards")
    to.write_shards(df.repartitionById(11, "shard"), path, seq_len=64, shard_len=100)
    files = sorted(tmp_path.glob("shards/shard=*/part-*"), key=lambda f: int(f.parent.name[6:]))
    assert [f.stat().st_size for f in files] == [100 * to.stride(64)] * 10 + [24 * to.stride(64)]
    whole = np.concatenate([np.fromfile(f, to.record(64)) for f in files])
    assert (whole["ids"] == grid).all() and (whole["seq_no"] == np.arange(1024) % 3).all()
    want = {r.slot: r.k for r in df.selectExpr("slot", "if(doc_id is null, null, xxhash64(doc_id)) as k").collect()}
    got = to.read_from(spark, path, 0, 100, 64).collect()
    assert {r.slot: r.doc_id for r in got} == want and all(r.offset == r.slot % 100 * to.stride(64) for r in got)


def test_no_rows_no_shards(spark, odd, tmp_path):
    path = str(tmp_path / "none")
    to.write_shards(to.training_order(odd.filter("false"), PATH), path)
    assert to.written_shards(spark, path) == [] and to.read_from(spark, path, 0).count() == 0 and list(to.sequences_from(path, 0)) == []


def test_empty_null_and_repeated(spark, odd):
    assert to.training_order(odd.filter("false"), PATH).count() == 0
    rows = to.training_order(documents(spark, ["a b", "a b", None, ""], ids=[1, 1, None, 4]), PATH).collect()
    assert sorted(((r.doc_id or 0), r.n_tokens) for r in rows) == [(0, 1), (1, 3), (1, 3), (4, 1)]
    assert sorted(r.slot for r in rows) == [0, 1, 2, 3]


def test_same_input_gives_same_slots(spark, odd):
    a, b = (sorted((r.doc_id, r.seq_no, r.slot) for r in to.training_order(odd, PATH, seq_len=64).collect()) for _ in range(2))
    assert a == b


def test_resume_of_another_numbering_is_refused(spark, tmp_path):
    """Other splits give other slots: the shards that are there belong to another permutation."""
    docs = documents(spark, [f"text {i} " * i for i in range(60)])
    a, b = (to.training_order(docs.repartition(n), PATH, seq_len=32, shard_len=8) for n in (2, 5))
    path = str(tmp_path / "shards")
    to.write_shards(a.filter("shard < 3"), path, seq_len=32, shard_len=8)
    with pytest.raises(ValueError, match="another numbering"):
        to.write_shards(b, path, seq_len=32, shard_len=8)
    assert to.written_shards(spark, path) == [0, 1, 2]


@pytest.mark.parametrize("n", [60, 3, 0])
def test_shards_written_in_turns_are_those_of_the_order(spark, tmp_path, n):
    """A range of shards at a time: the same files, nothing staged is left, no shuffle but a
    turn's is kept, and a run that broke off is resumed."""
    docs = documents(spark, [f"text {i} " * i for i in range(n)]).repartition(3) if n else documents(spark, ["x"]).filter("false")
    want = sorted((r.slot, r.shard, r.doc_id, r.seq_no, r.n_tokens, bytes(r.tokens)) for r in to.training_order(docs, PATH, seq_len=32, shard_len=8).collect())
    before, setting = set(to.staged(spark)), spark.conf.get(to.CLEANUP)
    path, jvm = str(tmp_path / "shards"), spark.sparkContext._jvm
    to.write_order(docs, PATH, path, seq_len=32, shard_len=8)
    for again in (False, True):
        if again and n == 60:   # the last shard is gone
            last = to.written_shards(spark, path)[-1]
            to.drop_path(spark, f"{path}/shard={last}")
            to.write_order(docs, PATH, path, seq_len=32, shard_len=8)
        got = to.read_from(spark, path, 0, 8, 32).collect()
        assert sorted((r.slot, r.shard, r.doc_id, r.seq_no, r.n_tokens, bytes(r.tokens)) for r in got) == want
    assert all(len(list(f.glob("part-*"))) == 1 for f in tmp_path.glob("shards/shard=*"))
    assert set(to.staged(spark)) == before and spark.conf.get(to.CLEANUP) == setting
    left = jvm.org.apache.hadoop.fs.Path(to.stage_path(spark, "")).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert not (left.globStatus(jvm.org.apache.hadoop.fs.Path(to.stage_path(spark, "turns-*"))) or [])
