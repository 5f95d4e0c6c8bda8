import corpus_pipeline
from rowlens.llm.queries import ORACLES, QUERIES


def test_stages_keep_the_columns_of_documents(llm, sf):
    docs = first = llm.read.parquet(f"{sf}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(llm, docs, sf)
        assert docs.columns == first.columns and docs.dtypes == first.dtypes, name
    assert docs.count() > 0


def test_run_packs_every_token_once(llm, sf):
    pieces = corpus_pipeline.run(llm, sf).collect()
    sequences = {}
    for p in pieces:
        sequences[p.sequence_id] = sequences.get(p.sequence_id, 0) + p.length
    assert pieces and max(sequences.values()) <= 1024


def test_every_oracle_has_a_query():
    assert ORACLES.keys() <= QUERIES.keys()
