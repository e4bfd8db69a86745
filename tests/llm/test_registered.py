"""The registered queries themselves, on small tables: against their SQL, or against plain versions of the whole contract."""

import binascii
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chorale.llm import decontam, langid, queries
from chorale.llm.queries import ORACLE_SQL, QUERIES

from test_operators import HARD, luhn, plain_components, plain_distance, plain_fingerprint, plain_spans, words

duckdb = pytest.importorskip("duckdb")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents (a bad host, licences, copies, personal data, passages, two languages), pages and benchmark."""
    at, rng = tmp_path_factory.mktemp("tables"), random.Random(20)
    items = [(i, prose(rng, 25)) for i in range(5)] + [(5, None), (6, "zq")]
    texts = list(HARD) + ["zq", "xzqx"]
    licences = ("Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.")
    while len(texts) < 260:
        n, text = len(texts), prose(rng, rng.randrange(55, 120))
        text = text if n % 2 else text.translate(str.maketrans("aceg", "klmn"))  # another language
        if n % 7 == 0:
            text += "\n" + licences[n % 3] + "\n" + prose(rng, 5)
        if n % 9 == 0:
            text += " " + items[n % 5][1].upper() + " " + prose(rng, 5)
        if n % 10 == 0:
            digits = "".join(rng.choice("0123456789") for _ in range(15))
            text += f" mail me{n}@x.org card {digits + next(x for x in '0123456789' if luhn(digits + x))} from 10.0.0.{n}"
        if n % 11 == 0:
            text = " ".join(f"{w} #|" for w in text.split())
        if n % 13 == 0:
            text = texts[n - 26]
        texts.append(text)
    lang = lambda i: "aa" if i % 2 else "bb"
    rows = [(i, t, None if i % 17 == 0 else lang(i), "bad" if i % 5 == 0 else "good" if i % 3 else None, None) for i, t in enumerate(texts)]
    rows = [(i, "short", la, s, n) if s == "bad" and i % 25 else (i, t, la, s, n) for i, t, la, s, n in rows]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(at / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(at / "benchmark.parquet"))
    hosts = ("a.example.org", "B.example.com", "www.c.org:80", "x.net")
    urls = [None, "no url", "http://"] + [f"http{'s' * (i % 2)}://{hosts[i % 4]}/{('en', 'de', 'fr')[i % 3]}/{i * 7}{('', '?a=1&utm_source=x', '#t', '.html')[i % 4]}" for i in range(200)]
    spark.createDataFrame([(i, u, None if i % 30 == 0 else f"<p>{i % 4}</p>") for i, u in enumerate(urls)], "page_id long, url string, html string").write.parquet(str(at / "pages.parquet"))
    return str(at), rows, items


@pytest.fixture(scope="module")
def results(spark, tables):
    """The rows of every query as dictionaries."""
    held = {}

    def of(name):
        if name not in held:
            held[name] = [r.asDict() for r in QUERIES[name](spark, tables[0]).collect()]
        return held[name]

    return of


def shown(value):
    return round(value, 9) + 0.0 if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(tables, results, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables[0]}/{t}.parquet/*.parquet'")
    found = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    expected = [dict(zip(columns, row)) for row in found.fetchall()]
    key = lambda rows: sorted(str([(c, shown(r[c])) for c in sorted(columns)]) for r in rows)
    assert key(results(name)) == key(expected)


def test_methods_decide(results):
    """The rows that only the named method can give are there."""
    revisits = results("op1_revisit_asof")
    assert {r["outcome"] for r in revisits} == {"resolved", "mismatch", "unverified", "orphan"}
    assert sum(r["response_id"] // 4 != r["page_id"] for r in revisits if r["response_id"] >= 0) >= 0.05 * len(revisits)
    assert {(r["rule"] is None, r["verdict"]) for r in results("op4_sorted_digest_array")} == {(True, "allow"), (True, "block"), (False, "allow"), (False, "block")}
    quality = results("op6_host_quality_rules")
    assert any(not r["rules_failed"] and not r["kept"] for r in quality) and any(r["rules_failed"] and not r["base_failed"] for r in quality)
    licences = results("op7_license_scan")
    assert {r["via"] for r in licences} == {"header", "file", "inherited", None}
    assert len({r["from_dir"].count("/") for r in licences if r["via"] == "inherited"}) >= 2


def test_leaks(tables, results):
    _, rows, items = tables
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in results("op2_pigeonhole_leaks")}
    expected = {}
    for i, text, *_ in rows:
        text = decontam.normalise(text or "")
        for k, item in items:
            item = decontam.normalise(item or "")
            if item and len(text) < 5000 and (d := plain_distance(item, text)) <= decontam.budget(len(item) - 2):
                expected[i, k] = d
    assert got == expected and len(got) > 20


def test_shards(tables, results):
    _, rows, _ = tables
    by_id, found = {i: t for i, t, *_ in rows}, results("op3_histogram_sort")
    assert sorted(r["doc_id"] for r in found) == sorted(by_id)
    for r in found:
        raw = (by_id[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    upto = np.cumsum([0, *(r["size"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"])))])
    for i in range(1, 16):  # each boundary is the nearest between two rows, or meets the tolerance
        target, first = upto[-1] * i / 16, sum(r["shard"] < i for r in found)
        assert abs(upto[first] - target) <= max(abs(upto - target).min(), 1e-4 * upto[-1] / 16)
    for s in range(16):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(sum(r["shard"] == s for r in found)))
    order = {}
    for r in found:
        order.setdefault(r["text_crc32"], []).append((r["shard"], r["slot"]))
    for places in order.values():  # equal texts are neighbours
        places.sort()
        assert all(b == (a[0], a[1] + 1) or (b[0] > a[0] and b[1] == 0) for a, b in zip(places, places[1:]))


def test_spans(tables, results):
    _, rows, _ = tables
    by_id = {i: t for i, t, *_ in rows}
    for r in results("op5_checked_pii_spans"):
        base = plain_spans(by_id[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [len(re.findall(f"(?:^|,){k}:", base)) for k in ("email", "ip", "card", "phone")]
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))


def test_tokens(tables, results):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    by_id = {i: x for i, x, *_ in tables[1]}
    for r in results("op8_rank_array_bpe"):
        ids = t.encode(by_id[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_fingerprints(tables, results):
    by_id, found = {i: t for i, t, *_ in tables[1]}, sorted(results("op9_pigeonring_simhash"), key=lambda r: r["doc_id"])
    fps = [plain_fingerprint(by_id[r["doc_id"]]) for r in found]
    assert [r["fingerprint"] for r in found] == [f"{f:016x}" for f in fps]
    assert [r["component_id"] for r in found] == plain_components(fps, [r["doc_id"] for r in found])


def grams(text):
    """The buckets of the text's n-grams, one at a time."""
    mask, text, out = (1 << 64) - 1, f" {text.lower()} ", []
    factors = [int(f) for f in langid._FACTORS]
    for n in langid.LENGTHS:
        for i in range(len(text) - n + 1):
            h = n * factors[2] & mask
            for k in range(n):
                h = (h ^ (ord(text[i + k]) + 1) * factors[k] & mask) * factors[0] & mask
            out.append(h >> int(langid._TOP))
    return out


def test_languages_by_plain_bayes(tables, results):
    _, rows, _ = tables
    out = lambda i: binascii.crc32(str(i).encode()) % 4 == 2
    counts, docs = {}, {}
    for i, text, lang, *_ in rows:
        if not out(i) and lang is not None and text is not None:
            mine = counts.setdefault(lang, np.zeros(langid.BUCKETS))
            docs[lang] = docs.get(lang, 0) + 1
            np.add.at(mine, grams(text), 1)
    logs = {la: np.log((c + langid.SMOOTHING) / (c.sum() + langid.SMOOTHING * langid.BUCKETS)) for la, c in counts.items()}
    by_id, right, held = {r[0]: r for r in rows}, 0, 0
    for r in results("op10_hashed_ngram_bayes"):
        _, text, lang, *_ = by_id[r["doc_id"]]
        assert r["held_out"] == out(r["doc_id"]) and 0 <= r["score"] <= 1
        if not text or not any(map(str.isalpha, text)):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        if len(text) < 5000:
            found = grams(text)
            totals = {la: logs[la][found].sum() + np.log(docs[la] / sum(docs.values())) for la in sorted(logs)}
            best = max(totals, key=totals.get)
            share = 1 / sum(np.exp((t - totals[best]) / len(found) * min(langid.EVIDENCE, len(found))) for t in totals.values())
            assert r["lang_pred"] == best and r["score"] == pytest.approx(share, abs=1e-4)
        if r["held_out"] and lang is not None and len(text) > 100:
            held, right = held + 1, right + (r["lang_pred"] == lang)
    assert held > 20 and right / held > 0.95


def test_hashes_are_those_of_the_library():
    assert xxhash.xxh64_intdigest(b"a", 42) != xxhash.xxh64_intdigest(b"a")


# Clashing columns: every name that an operator uses inside, and every result's, in a table that has them all.

INSIDE = (
    "key", "size", "cell", "digits", "task", "start", "row", "rank", "shard", "slot", "rows", "bytes", "solid", "g", "host", "path", "rule", "verdict", "judged", "pii", "given", "spans", "ends", "high", "pieces",
    "match_email", "between_ip", "length_card", "start_phone", "words", "lines", "n_lines", "windows", "in_order", "marks", "n_words", "kept", "host_rate", "rules_failed", "their_host", "license", "cosine", "via", "from_dir",
    "units", "term", "unit_no", "c0", "c1", "ids", "decoded", "pair", "fp", "component_id", "component", "node", "root", "best", "of", "bands", "leaks", "some", "lang_pred", "score", "at", "found", "bucket", "near", "far",
    "canonical_url", "outcome", "response_id", "age", "merged_headers", "__key", "__m_email", "__words", "__fp", "__lang", "__rank", "__of", "__ordered", "others", "_", "a.b", "Text2",
)


def test_clashing_columns(spark):
    from chorale.llm import bpe, langid, license_scan, minhash, pii, quality, shard_sort, simhash, url_filter, warc
    import corpus_pipeline

    rng = random.Random(21)
    rows = [(i, prose(rng, 60), "en", "s") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in INSIDE]).cache()
    items = spark.createDataFrame([(1, rows[0][1])], "item_id long, text string")
    model = langid.learn(df)
    made = {
        "op2": (decontam.find_leaks(df, items), {"leaks"}), "op3": (shard_sort.histogram_shards(df, 2), {"size", "shard", "slot"}),
        "op4": (url_filter.filter_urls(df, [("org/", 0)], url_col="outcome"), {"host", "path", "rule", "verdict"}), "op5": (pii.find_pii(df), {"pii"}), "redact": (pii.redact(pii.find_pii(df)), {"pii"}),
        "op6": (quality.apply_rules(df), set(quality.RESULTS)), "op7": (license_scan.scan_licenses(df), {"license", "cosine", "via", "from_dir"}), "op8": (bpe.bpe_encode(df, queries.tokenizer_path()), {"ids", "decoded"}),
        "op9": (simhash.near_duplicates(df), {"fp", "component_id"}), "op10": (langid.predict(df, model), {"lang_pred", "score"}), "copies": (minhash.deduplicate(df), set()),
        **{name: (stage(spark, df, ""), set()) for name, stage in corpus_pipeline.STAGES if name in ("quality rules", "SimHash near-dedup", "personal data")},
    }
    captures = df.select("*", F.lit("http://a.org").alias("url"), F.col("doc_id").alias("captured_at"), F.lit("revisit").alias("record_type"), F.lit(304).alias("status"), F.create_map(F.lit("a"), F.lit("b")).alias("headers"), F.col("doc_id").alias("record_id"))
    made["op1"] = warc.resolve_revisits(captures), set(warc._RESULTS)
    for name, (out, results) in made.items():
        got = out.collect()
        assert len(got) == 4, name
        for c in INSIDE:
            if c not in results:
                assert {(r["doc_id"], r[c]) for r in got} == {(i, f"{c}:{i}") for i in range(4)}, (name, c)
        assert len({c.lower() for c in out.columns}) == len(out.columns), name


def test_texts_in_columns_named_like_results(spark):
    from chorale.llm import bpe, pii, quality, simhash

    df = spark.createDataFrame([(0, "mail a@b.cc"), (1, None)], "doc_id long, text string")
    assert pii.find_pii(df.withColumnRenamed("text", "pii"), "pii").select(F.size("pii")).collect() == pii.find_pii(df).select(F.size("pii")).collect()
    assert quality.apply_rules(df.withColumnRenamed("text", "kept"), "doc_id", "kept").count() == 2
    assert bpe.bpe_encode(df.withColumnRenamed("text", "ids"), queries.tokenizer_path(), "ids").columns == ["doc_id", "ids", "decoded"]
    assert simhash.near_duplicates(df.withColumnRenamed("text", "fp"), text_col="fp").count() == 2


def test_broadcast_limits_change_nothing(spark, tables, results, monkeypatch):
    from chorale.llm import license_scan, minhash, quality, simhash
    import corpus_pipeline

    docs = spark.read.parquet(tables[0] + "/documents.parquet")
    plain = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, tables[0]).collect())
    for module, name in ((quality, "BROADCAST_HOSTS"), (simhash, "BROADCAST_KEYS"), (license_scan, "BROADCAST_TERMS"), (minhash, "BROADCAST_ROWS")):
        monkeypatch.setattr(module, name, 0)
    for name in ("op6_host_quality_rules", "op7_license_scan", "op9_pigeonring_simhash"):
        key = lambda rows: sorted(str([(c, shown(v)) for c, v in sorted(r.items())]) for r in rows)
        assert key(r.asDict() for r in QUERIES[name](spark, tables[0]).collect()) == key(results(name))
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, tables[0]).collect()) == plain


def test_a_full_memory_and_unspaced_texts(monkeypatch):
    from chorale.llm import bpe

    description = open(queries.tokenizer_path(), encoding="utf-8").read()
    roomy = bpe.Tokenizer(description)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    tight, rng = bpe.Tokenizer(description), random.Random(22)
    texts = [prose(rng, 40) for _ in range(5)] + ["中文字" * 5000, "QUJD" * 3000 + "=="]
    assert [tight.encode(t) for t in texts] == [roomy.encode(t) for t in texts]
    assert max(map(len, roomy.of_chunk)) <= bpe.REMEMBERED_CHARS and max(map(len, roomy.of_word)) <= bpe.REMEMBERED_CHARS


# The pipeline, by plain versions of its five stages.

def plain_pipeline(rows, items, tokenizer):
    from test_operators import plain_metrics

    def rules(text):
        n, chars, symbols, dups, repeats = plain_metrics(text)
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        return n < 50 or 100 * repeats > 50 * n or 100 * symbols > 10 * n or 100 * dups > 50 * len(lines) or not 3 * n <= chars <= 10 * n

    hosts = {}
    for _, text, _, source, _ in rows:
        n, f = hosts.get(source, (0, 0))
        hosts[source] = n + 1, f + rules(text)
    total, failed = (sum(h[i] for h in hosts.values()) for i in (0, 1))
    mean = failed / total
    spread = sum(n * (f / n - mean) ** 2 for n, f in hosts.values())
    between = (spread - (len(hosts) - 1) * mean * (1 - mean)) / (total - sum(n * n for n, _ in hosts.values()) / total)
    strength = min(max(mean * (1 - mean) / between - 1, 2), 1000) if between > 0 else 1000
    rejected = {h for h, (n, f) in hosts.items() if (f + mean * strength) / (n + strength) >= 0.5}
    kept = sorted((r for r in rows if not rules(r[1]) and r[3] not in rejected), key=lambda r: r[0])

    def shingles(text, n):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c[0].lower(), text))
        return [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]

    def bits(text):
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, 5)]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    sets, prints, root = [set(shingles(r[1], 5)) for r in kept], [bits(r[1]) for r in kept], list(range(len(kept)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(kept)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) or bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    kept = [r for i, r in enumerate(kept) if find(i) == i]

    wanted = [x for x in (decontam.normalise(t or "") for _, t in items) if x]
    clean = [r for r in kept if not any(plain_distance(w, decontam.normalise(r[1])) <= decontam.budget(len(w) - 2) for w in wanted)]

    out = {}
    for i, text, lang, source, _ in clean:
        spans = sorted((int(a), -int(b), k) for k, a, b in (s.split(":") for s in plain_spans(text).split(",") if s))
        masked, at = "", 0
        for a, minus, kind in spans:
            if a >= at:
                masked += text[at:a] + f"[{kind.upper()}]"
            at = max(at, -minus)
        masked += text[at:]
        ids = tokenizer.encode(masked, add_special_tokens=False).ids
        out[i] = lang, source, len(masked), len(ids), np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)
    return out


def test_pipeline(tables, results, spark):
    tokenizers = pytest.importorskip("tokenizers")
    import corpus_pipeline

    tokenizer = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    at, rows, items = tables
    got = {r["doc_id"]: (r["lang"], r["source"], r["n_chars"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in corpus_pipeline.run(spark, at).collect()}
    expected = plain_pipeline(rows, items, tokenizer)
    assert got == expected and 50 < len(got) < 200
