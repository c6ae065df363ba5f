"""Each stage against a plain version of its decisions, on its own input."""

import public_tokenizers
import tiktoken

import corpus_pipeline
from invspark.llm import bpe, mixing, pii, queries
from invspark.session import materialise
from tests.llm.test_quality import failed, measured

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, schema = docs.columns, docs.dtypes
    states = [docs]
    for name, stage in corpus_pipeline.STAGES:
        states.append(materialise(stage(spark, states[-1], SF), name))
    raw, good, single, clean, mixed, encoded = ({r.doc_id: r for r in s.collect()} for s in states)
    for state in states[:-1]:
        assert state.columns == columns and state.dtypes == schema
    assert set(good) == {i for i, r in raw.items() if failed(measured(r.text)) == 0}
    assert set(single) <= set(good) and len({r.text for r in single.values()}) == len(single)
    assert {r.text for r in good.values()} >= {r.text for r in single.values()}
    assert set(clean) == set(single)
    for i, r in clean.items():
        entities = pii.detect(single[i].text)
        assert (r.text == single[i].text) == (not entities) and r.n_chars == len(r.text)
        assert not any(e.value in r.text for e in entities)
    assert set(mixed) <= set(clean) and all(mixed[i] == clean[i] for i in mixed)
    drawn = mixing.mix(states[3], queries.MIX, queries.MIX_RATE, queries.MIX_KEY).collect()
    assert {r.doc_id for r in drawn if r.sampled} == set(mixed)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.read_ranks(open(public_tokenizers.path(queries.VOCABULARY), "rb").read())
    )
    assert set(encoded) == set(mixed)
    for i, r in encoded.items():
        assert r.ids == library.encode_ordinary(mixed[i].text) and r.n_tokens == len(r.ids)


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"word{i}" for i in range(3000))
    rows = [(None,) * 5, (1, None, None, None, None), (2, "", "en", "src0", 0), (3, long, "xx", None, 1), (3, long, "xx", None, 1), (None, long + " end", None, "s", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = materialise(stage(spark, docs, SF), name)
            assert out.count() <= len(data)
            if name != "byte_level_bpe":
                assert out.columns == docs.columns


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "pii_surrogates", "mixing", "byte_level_bpe"]
