"""The pipeline's stages on a small corpus, against what each must do."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chorale.llm import minhash


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(n))


def test_run(spark, tmp_path):
    item = prose("item", 30)
    texts = [prose(0), prose(0), prose(1) + " mail me@x.org", prose(2) + " " + item.upper(), "short", None, "spam spam spam " * 60, prose(3)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)] + [(7, texts[7], "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("extra", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(out) == [0, 2, 7]
    assert "email" in out[2]["decoded"] and "x" not in out[2]["decoded"].split() and out[2]["n_chars"] == len(prose(1) + " mail [EMAIL]")
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in out.values())


def edited(text, seed, n):
    rng, w = random.Random(seed), text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = "new" + str(rng.randrange(10**6))
    return " ".join(w)


@pytest.mark.parametrize("dense", [2, 32])
def test_edited_copies_go(spark, monkeypatch, dense):
    monkeypatch.setattr(minhash, "DENSE", dense)
    texts = [None, "", " \n", "a b", "A  b", "a b c"]
    for i in range(30):
        base = prose(f"base{i}", 300)
        texts += [base] + [edited(base, f"{i} {k}", k) for k in (1, 3, 5, 6, 20)]
    hot = prose("hot", 400)
    texts += [edited(hot, f"hot{k}", 2) for k in range(60)]
    sets = [minhash.shingles_of((t or "").encode()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if minhash.similar(a, sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    expected = sorted(i for i in range(len(texts)) if find(i) == i)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == expected and 30 < len(expected) < 120


def test_stages_on_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_dense_bands_lose_no_link(spark, monkeypatch):
    """A chain of texts, each like the next, in bands where leaders and finer keys reached few: it stays one group."""
    monkeypatch.setattr(minhash, "DENSE", 2)
    monkeypatch.setattr(minhash, "LEADERS", 1)
    words = [f"w{n}" for n in range(1200)]
    texts = [" ".join(words[4 * n : 4 * n + 60]) for n in range(120)]
    sets = [minhash.shingles_of(t.encode()) for t in texts]
    assert all(minhash.similar(a, b) for a, b in zip(sets, sets[1:])) and not minhash.similar(sets[0], sets[2])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bands = [set(minhash.signature_of(t.encode())[3]) for t in texts]
    root = list(range(len(texts)))
    for n in range(1, len(texts)):
        if bands[n] & bands[n - 1]:
            root[n] = root[n - 1]
    assert sorted(r["doc_id"] for r in minhash.deduplicate(docs).collect()) == sorted(set(root))
