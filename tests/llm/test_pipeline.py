import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from duolog.llm import exact_dedup, ngram_join, quality, toxicity
from duolog.llm.queries import vocabulary_path
from tests.llm.test_ngram_join import shingles
from duolog.llm._components import connected_components

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_stages_work_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    good = docs.join(quality.scored(docs, labels).where("predicted = 1").select("doc_id"), "doc_id").select(*docs.columns).cache()
    clean = good.join(toxicity.scored(good, labels).where("predicted = 0").select("doc_id"), "doc_id").select(*docs.columns).cache()
    single = clean.join(exact_dedup.duplicate_groups(clean).where("kept").select("doc_id"), "doc_id").select(*docs.columns).cache()
    apart = single.join(ngram_join.near_duplicates(single).where("component_id = doc_id").select("doc_id"), "doc_id").cache()
    found = corpus_pipeline.run(spark, DATA)
    assert ids(found) == ids(apart) < ids(docs)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "exact_dedup", "ngram_join", "packing"]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 260)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (9, 8), (8, 9)], "src long, dst long")
    found = {r.node: r.root for r in connected_components(edges).collect()}
    groups = [set(range(100, 161)), {5, *range(200, 260)}, {8, 9}]
    assert found.keys() == set().union(*groups)
    assert [len({found[n] for n in g}) for g in groups] == [1, 1, 1] and len(set(found.values())) == 3
    assert connected_components(edges.limit(0)).count() == 0


def one_of_each_text(rows):
    """Per id and blank-free text the longest row, and of equal texts the longest with the smallest id (null last)."""
    best = {}
    for r in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        key = (r.doc_id is None, -len(r.text or "") if r.doc_id is not None else 0, r.doc_id or 0)
        if norm not in best or key < best[norm][0]:
            best[norm] = (key, r)
    return sorted(re.sub(r"[\x20\x09-\x0D]", "", r.text or "") + f"|{r.doc_id}" for _, r in best.values())


def groups_of_near_copies(rows):
    sets, group = [shingles(r.text) for r in rows], list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                group[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_stages_against_brute_force_on_odd_rows_and_clashing_names(spark):
    """The last three stages are held against plain Python; the first two against the scores of single rows."""
    clash = {"_sha": "s", "_row": "r", "_near_id": "n", "_near_key": "k", "_near_none": "o", "key": "y", "cls": "c", "n": "m", "digest": "d", "score": "e", "_shard": "h"}
    odd = [(None, "alone " * 30), (None, "alone " * 30), (None, None), (9001, None), (9002, ""), (9003, " \n "), (9004, "a b  c d"), (9004, "a b c d"), (9004, "other words of the same id here"), (9005, "ab cd"), (9006, "word " * 60000)]
    odd += [(9010 + k, " ".join(f"x{i}" for i in range(40)) + " tail" * k) for k in range(4)]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(d, t, "en", "s", 1) for d, t in odd], docs.schema)).withColumns({k: F.lit(v) for k, v in clash.items()})
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = docs
    for name, module, good in (("quality", quality, 1), ("toxicity", toxicity, 0)):
        out = stages[name](spark, kept, DATA)
        assert out.columns == docs.columns
        score = {}
        for r in module.scored(kept.select("doc_id", "text").withColumn("doc_id", F.coalesce("doc_id", F.lit(-1))), labels).select("doc_id", "predicted").collect():
            score.setdefault(r.doc_id, []).append(r.predicted)
        want = sorted(d for d, p in score.items() for x in p if x == good)
        assert sorted(-1 if r.doc_id is None else r.doc_id for r in out.select("doc_id").collect()) == want
        kept = spark.createDataFrame(out.collect(), docs.schema if not clash else out.schema)
    kept = kept.unionByName(docs.where("doc_id > 9000 or doc_id is null")).distinct().unionByName(docs.where("doc_id = 9010"))  # edges reach the later stages too
    rows = kept.collect()
    single = stages["exact_dedup"](spark, kept, DATA)
    assert single.columns == docs.columns
    single = spark.createDataFrame(single.collect(), single.schema)
    assert sorted(re.sub(r"[\x20\x09-\x0D]", "", r.text or "") + f"|{r.doc_id}" for r in single.collect()) == one_of_each_text(rows)
    rows = single.collect()
    apart = stages["ngram_join"](spark, single, DATA)
    assert apart.columns == docs.columns
    group = groups_of_near_copies(rows)
    least = {}
    for g, r in zip(group, rows):
        if g not in least or (r.doc_id is None, r.doc_id or 0) < (least[g].doc_id is None, least[g].doc_id or 0):
            least[g] = r
    assert sorted((str(r.doc_id), r.text or "") for r in apart.collect()) == sorted((str(r.doc_id), r.text or "") for r in least.values())
    library = Tokenizer.from_file(vocabulary_path())
    library.no_truncation()
    want = []
    for r in apart.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(str(r.doc_id), k, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    packed = stages["packing"](spark, apart, DATA).collect()
    assert sorted((str(r.doc_id), r.piece, r.length, r.ids_crc32) for r in packed) == sorted(want)
    end = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == end.get(r.sequence_id, 0)
        end[r.sequence_id] = r.offset + r.length
    assert max(end.values()) <= 4096
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
