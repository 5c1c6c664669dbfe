"""What packing returns holds the token ids, so that sequences can be built from it."""

import zlib

import numpy as np
import public_tokenizers
from llm import cases
from tokenizers import Tokenizer

import corpus_pipeline
from fleetmetrics.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_sequences_can_be_built_from_the_last_stage(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    rows = [*cases.awkward_texts(), (3, cases.prose(77, 50))]
    docs = cases.frame(spark, rows)
    made = corpus_pipeline.packing_stage(spark, docs, "").collect()
    want = sorted((d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for d, t in rows if d is not None)
    got, sequences = {}, {}
    for r in made:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, ids))
        if r.doc_id is not None and r.length == r.doc_tokens:
            got.setdefault(r.doc_id, []).append(tuple(ids))
    short = [(d, t) for d, t in want if len(t) <= 2048]
    assert sorted((d, t) for d, found in got.items() for t in found) == short
    for parts in sequences.values():
        end = 0
        for offset, ids in sorted(parts):
            assert offset == end
            end += len(ids)
        assert end <= 2048


def test_query_columns(spark):
    made = queries.op10_packing(spark, SF_DIR)
    assert made.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert {t for _, t in made.dtypes} <= {"bigint"} | {dict(made.dtypes)["doc_id"]}
