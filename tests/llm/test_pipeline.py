"""Stages of the pipeline, on rows without an id, without words and without a source."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row

import corpus_pipeline
from staytally import fs
from staytally.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RANDOM = np.random.default_rng(5)
PASSAGE = "this passage of the benchmark has more words than ten of them in all"


def text_of(n):
    return " \n".join(f"v{i}" for i in RANDOM.integers(5000, size=n))


@pytest.fixture(scope="module")
def rows():
    texts = [(i if i % 3 else None, text_of(30 + i), f"s{i % 4}" if i % 4 else None) for i in range(80)]
    texts += [(100 + i, t, "s1") for i, t in enumerate((None, "", " \n", None))]
    texts += [(None, t, "s2") for t in (None, "", " ", "one")]
    texts += [(7, "another text of a used id", "s3"), (200, text_of(9000), "long"), (201, "\t", "blank")]
    return [(i, t, "en", s, len(t or "")) for i, t, s in texts]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_mixture_takes_what_the_mix_decides(spark, docs, rows):
    size, target = Counter(), {}
    for r in mixing.mix_sources(docs).collect():
        size[r.source] += r["size"]
        target[r.source] = r.target
    words, whole = Counter(), [t or "" for _, t, *_ in rows]
    got = corpus_pipeline.mixture(spark, docs, "").collect()
    for r in got:
        n = len(WORD.findall(r.text))
        assert n and r.n_chars == len(r.text) and any(r.text in t for t in whole)
        words[r.source] += n
    assert size["blank"] == words["blank"] == 0
    assert all(abs(words[s] - target[s]) <= 2 * mixing.BLOCK for s in size)
    nothing = corpus_pipeline.mixture(spark, docs.limit(0), "")
    assert nothing.columns == docs.columns and nothing.count() == 0


def test_pieces_are_what_is_taken(docs):
    for r in mixing.mix_sources(docs, keep=("pieces",)).collect():
        assert sum(p.stop - p.start for p in r.pieces) == r.taken
        assert all(0 <= p.start < p.stop <= r["size"] for p in r.pieces)


def test_near_copies_leave_one_and_rows_without_an_id_stay(spark, docs, rows):
    copy = [(500 + k, rows[1][1], "en", "s1", 9) for k in range(3)]
    more = docs.unionByName(spark.createDataFrame(copy, SCHEMA))
    got = corpus_pipeline.near_dedup(spark, more, "")
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))


def test_whole_run_passes_rows_without_words_and_ids(spark, docs, rows, tmp_path):
    folder, held = str(tmp_path), f"begin it {PASSAGE} end it"
    more = docs.unionByName(spark.createDataFrame([(600, held, "en", "s1", 9), (601, PASSAGE, "en", "s1", 9)], SCHEMA))
    more.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.quality(spark, more, folder).count() == len(rows) + 2
    clean = corpus_pipeline.decontamination(spark, more, folder)
    left = {r.doc_id: WORD.findall(r.text) for r in clean.where("doc_id >= 600").collect()}
    assert left == {600: ["begin", "it", "end", "it"]}
    assert clean.where("doc_id IS NULL").count() == sum(i is None for i, *_ in rows)
    assert corpus_pipeline.run(spark, folder).count() > 0


CLASHES = ["_row", "_start", "_stop", "_cut", "_piece", "_words", "_spans", "_items", "p_text", "p_good", "size"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:4])
def test_stages_keep_columns_of_any_name(spark, docs, tmp_path, name, stage):
    """Each row keeps what it holds in columns named like those of the operators."""
    folder = str(tmp_path)
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, i % 2, 0) for i in range(80)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    more = docs.selectExpr("*", *(f"concat('{c}', doc_id) AS {c}" for c in CLASHES))
    plain, got = stage(spark, docs, folder).collect(), stage(spark, more, folder).collect()
    assert sorted(map(str, plain)) == sorted(str(Row(**{c: r[c] for c in docs.columns})) for r in got)
    assert all(r[c] == (None if r.doc_id is None else f"{c}{r.doc_id}") for r in got for c in CLASHES)
    assert set(got[0].asDict()) == {*docs.columns, *CLASHES}


def test_a_stage_frees_what_the_one_before_it_left(spark, docs, tmp_path):
    shared = corpus_pipeline.Scratch(spark, "probe").path.rsplit("/", 1)[0]
    corpus_pipeline.mixture(spark, docs, "").write.parquet(f"{tmp_path}/mixed")
    left = {scratch.path for scratch in corpus_pipeline._opened}
    assert left and left <= {f"{shared}/{name}" for name in fs.names(spark, shared)}
    corpus_pipeline.token_shards(spark, spark.read.parquet(f"{tmp_path}/mixed"), "").count()
    assert not left & {f"{shared}/{name}" for name in fs.names(spark, shared)}


def test_mixture_agrees_with_itself_on_reruns(spark, docs):
    def taken(frame):
        return Counter((r.doc_id, r["size"], r.taken) for r in mixing.mix_sources(frame).collect())

    assert taken(docs) == taken(docs) == taken(docs.repartition(7))
