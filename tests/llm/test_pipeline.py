import corpus_pipeline
from cinelake.llm import pieces
from tests.llm import odd
from tests.llm.test_simhash import fingerprint, roots
from tests.llm.test_suffixes import brute

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    inputs = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append(docs)
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    tables = [{r.doc_id: r for r in d.collect()} for d in [*inputs, docs]]
    sizes = [len(t) for t in tables]
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] == sizes[5]

    root = roots([fingerprint(r.text) for r in tables[1].values()])
    low = {}
    for key in sorted(tables[1]):
        low.setdefault(root[fingerprint(tables[1][key].text)], key)
    assert sorted(tables[2]) == sorted(low.values())

    want = {r[0]: r for r in brute([(k, r.text) for k, r in tables[2].items()], 200)}
    for key, r in tables[3].items():
        assert r.n_chars == len(r.text) and len(r.text.encode()) <= want[key][1] - want[key][2]
        if not want[key][2]:
            assert r.text == tables[2][key].text

    leaked = {k for k, r in tables[3].items() if any(t in r.text for t in items)}
    assert not leaked & set(tables[4]) and sizes[3] - sizes[4] <= len(leaked) + 2

    vocabulary = pieces.load()
    assert all(r.lossless and pieces.decode(vocabulary, r.ids) == tables[4][k].text for k, r in tables[5].items())


def test_odd_and_empty_documents(spark, tmp_path):
    for name, docs in (("odd", odd.documents(spark)), ("none", odd.documents(spark, empty=True))):
        sf = str(tmp_path / name)
        odd.labels(spark).write.parquet(f"{sf}/labels.parquet")
        docs.write.parquet(f"{sf}/documents.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{sf}/benchmark.parquet")
        assert corpus_pipeline.run(spark, sf).count() == (0 if name == "none" else 9)
