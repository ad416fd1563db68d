"""The pipeline against a plain version of its stages, and the registered queries' shapes."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from millpond.llm import decontamination, language_id, secret_scan, simhash
from millpond.llm.queries import WORDS
from tests.llm.test_dedup_ops import groups_of, plain_fingerprint, plain_tiles_cover
from tests.llm.test_text_ops import plain_base


def words_of(text):
    return "".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in text).split()


def test_pipeline_by_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = language_id.train(docs.select("text", "lang"))
    rows = {i: t for i, t in rows.items() if not model.classify([t])[0][3]}
    ids = sorted(rows)
    prints = np.array([plain_fingerprint(rows[i]) for i in ids], np.uint64)
    linked = [(a, b) for a in range(len(ids)) for b in range(a) if int(prints[a] ^ prints[b]).bit_count() <= 3]
    label = groups_of(len(ids), linked)
    rows = {i: rows[i] for k, i in enumerate(ids) if label[k] == k}
    items = [words_of(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    for i, text in list(rows.items()):
        words = words_of(text)
        fives = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for item in items:
            shared = any(tuple(item[k : k + 5]) in fives for k in range(len(item) - 4))
            if shared and plain_tiles_cover(words, item, 5) >= decontamination.COVERAGE * len(item):
                rows.pop(i)
                break
    library = Tokenizer.from_file(public_tokenizers.path(WORDS))
    library.no_truncation()
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, small).collect()}
    assert set(found) == set(rows)
    for i, text in rows.items():
        if plain_base(text):
            assert secret_scan.MASK.lower().strip("[]") in found[i].decoded
            continue
        ids = library.encode(text, add_special_tokens=False).ids
        if np.frombuffer(found[i].ids, "<u4").tolist() != ids:  # a run that the models take for random
            assert "secret" in found[i].decoded
        assert found[i].n_tokens == len(found[i].ids) // 4
    assert len(found) < docs.count()


def test_stages_keep_the_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small).schema.names == docs.schema.names


def test_registered():
    found = entry.queries()
    assert {int(k[2:].split("_")[0]) for k in found if k.startswith("op")} == set(range(1, 14)) and "pipeline" in found
    assert simhash.THRESHOLD == 3
