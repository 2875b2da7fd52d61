"""The pipeline against the operators' plain versions, stage by stage."""

import random

import corpus_pipeline
from tests.llm.common import SCHEMA, edge_documents, no_documents, prose, write_tables
from tests.llm.test_decontam import BENCH, ITEMS, scanned
from tests.llm.test_linededup import cleaned
from tests.llm.test_mixing import mixed
from tests.llm.test_neardup import brute, edited
from tests.llm.test_quality import judged


def plain(rows, items):
    """(doc_id, text, source, repeats) of distinct-id (doc_id, text, source)."""
    kept = {r[0] for r in judged(rows) if r[-1]}
    rows = [r for r in rows if r[0] in kept]
    text = {i: t for i, _, _, t in cleaned(rows)}
    rows = [(i, text[i], s) for i, _, s in rows]
    groups = brute([(i, t) for i, t, _ in rows])
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    bad = {r[0] for r in scanned([r[:2] for r in rows], items) if r[-1]}
    rows = [r for r in rows if r[0] not in bad]
    taken = {r[0]: (r[1], r[4]) for r in mixed(rows)}
    return sorted((i, t, s, taken[i][1] // taken[i][0]) for i, t, s in rows if taken[i][1])


def documents():
    r, rows = random.Random(11), []
    for k in range(160):
        source = r.choice(["a", "a", "a", "b", "c", None])
        text = "\n".join([prose(k, r.randrange(10, 200)), f"footer of {source} pages", prose(k + 500, 30)])
        rows.append((k, text, source))
    rows += [(200 + k, edited(rows[k % 8][1], k, 0.01 * (k % 3)), r.choice("ab")) for k in range(60)]
    rows += [(300 + k, prose(k, 30) + " " + ITEMS[0][1] + " " + prose(k + 9, 40), "b") for k in range(6)]
    rows += [(400 + k, "bad page", "junk") for k in range(30)]
    rows += [(450, prose(77, 90), "junk"), (451, "", "a"), (452, "same words again and " * 50, "b")]
    r.shuffle(rows)
    return rows


def test_pipeline_equals_plain_version(spark, tmp_dir):
    rows = documents()
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], SCHEMA)
    folder = write_tables(spark, tmp_dir, docs, spark.createDataFrame(ITEMS, BENCH))
    got = corpus_pipeline.run(spark, folder)
    assert got.columns[:5] == docs.columns
    expected = plain(rows, ITEMS)
    assert sorted((r.doc_id, r.text, r.source, r.mix_repeats) for r in got.collect()) == expected
    assert all(r.n_chars == len(r.text) for r in got.collect())


def test_stages_keep_columns_and_edge_rows(spark, tmp_dir):
    docs = edge_documents(spark, extra=True)
    folder = write_tables(spark, tmp_dir, docs, spark.createDataFrame(ITEMS, BENCH))
    for source in (docs, edge_documents(spark)):
        now = source
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = corpus_pipeline.written(stage(spark, now, folder), name)
            assert now.dtypes == source.dtypes, name
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, source, folder).write.format("noop").mode("overwrite").save()
    last = corpus_pipeline.mixing_sources(spark, docs.withColumnRenamed("host", "mix_size"), folder)
    assert last.columns[-4:] == ["mix_size_", "mix_source_size", "mix_target", "mix_repeats"]
    near = corpus_pipeline.near_dedup(spark, docs, folder).collect()
    ids = [r.doc_id for r in near]
    assert ids.count(None) == 2 and sorted(i for i in ids if i is not None) == sorted(
        {*range(1, 12), *range(20, 32), 40}
    )


def test_empty_documents(spark, tmp_dir):
    folder = write_tables(spark, tmp_dir, no_documents(spark), spark.createDataFrame(ITEMS, BENCH))
    assert corpus_pipeline.run(spark, folder).collect() == []
