"""The columns of op7 beside its score need no trained model and are those of the whole operator."""

from velora.llm import lm_score as op7
from velora.llm import queries

BASE = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]


def test_base_trains_nothing(spark, sf_dir, monkeypatch):
    def never(*_):
        raise AssertionError("a model was trained")

    monkeypatch.setattr(op7, "train", never)
    assert queries.lm_unigram_base(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_base_is_that_of_the_whole_operator(spark):
    texts = ["a b c a", "B c\td unseen", None, "", "rare words only here", "a a a b"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for head in (3, 150_000):  # most words outside the head, and none
        whole, base = (op7.lm_score(docs, head=head, cells=1 << 12, own_score=x).select(*BASE) for x in (True, False))
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, base.collect()))
    empty = op7.lm_score(docs.where("doc_id < 0"), own_score=False)
    assert empty.count() == 0 and empty.columns == [*BASE, "score"]
