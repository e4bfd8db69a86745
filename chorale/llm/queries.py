"""The queries of this folder, each over its whole table, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_encode
from .decontam import find_leaks
from .langid import held_out, learn, predict
from .license_scan import CUES, MIN_COSINE, TEMPLATES, WINDOWS, scan_licenses
from .pii import CONTEXT, KINDS, count_of, find_pii, spans_text
from .quality import METRICS, apply_rules
from .shard_sort import histogram_shards
from .shared import table, text_of
from .simhash import near_duplicates
from .url_filter import LISTED, RULE_ALLOW, RULE_BLOCK, filter_urls
from .warc import resolve_revisits

#: The rules of the URL query.
URL_RULES = (("org/", RULE_ALLOW), ("example.org/es/", RULE_BLOCK), ("example.org/en/1", RULE_BLOCK), ("com/fr/", RULE_ALLOW), ("com/de/", RULE_BLOCK))
#: The block list that decides where no rule fits: 24,000 starts of paths (a domain, a language, and every tenth of the
#: numbers up to 19,999) and two whole hosts.
LIST_DOMAINS, LIST_LANGUAGES, LIST_NUMBERS, LIST_EVERY = ("example.com", "example.net", "example.org"), ("de", "en", "es", "fr"), 20_000, 10
LIST_HOSTS = ("ads.example.net/", "tracker.example.com/")
#: A file of /opt/tokenizers.
TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def captures_of(pages: DataFrame) -> DataFrame:
    """Four captures that each page stands for, all of them in whole seconds.

    A page is fetched (record 4 p), three pages in the same second, and asked for again up to two days later (4 p + 1).  At the
    first time the section of its URL (all before the last number of the path) is fetched too (4 p + 2), and about then
    asked for (4 p + 3), so that the pages of a section share a canonical URL and its responses lie before, at
    and after its revisits.  A section changes every quarter of a day.  Some responses are no full ones, some captures have
    no entity tag or another one, and some have no Last-Modified.
    """
    page, text = F.col("page_id"), lambda c: c.cast("string")
    at = F.floor(page / 3).cast("long") * 180
    section = F.regexp_replace("url", r"(?s)[0-9]+[^0-9/?#]*/?([?#].*)?$", "")
    again, asked = at + 30 + 86400 * (page % 3), at + 60 * (page % 5) - 60
    content = F.concat(F.lit('"'), F.substring(F.md5(text_of("html").cast("binary")), 1, 16), F.lit('"'))
    version = lambda t: text(F.floor(t / 21600))

    def headers(date, tag, modified, age, length):
        fields = F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), text(date), F.lit("ETag"), tag, F.lit("Last-Modified"), modified,
            F.lit("Cache-Control"), F.concat(F.lit("max-age="), text(age)), F.lit("Content-Length"), text(length),
        )
        return F.map_filter(fields, lambda _, v: v.isNotNull())

    def row(k, url, when, kind, status, fields):
        return F.struct((4 * page + k).alias("record_id"), url.alias("url"), when.alias("captured_at"), F.lit(kind).alias("record_type"), status.alias("status"), fields.alias("headers"))

    length, weak = F.octet_length(text_of("html")), lambda tag: F.concat(F.lit("W/"), tag)
    state = lambda t: F.concat(F.lit('"s'), version(t), F.lit('"'))
    every = F.array(
        row(0, F.col("url"), at, "response", F.when(page % 13 == 0, 404).otherwise(200), headers(at, F.when(page % 5 != 0, content), F.when(page % 4 != 0, F.lit("monday")), F.lit(3600), length)),
        row(1, F.concat("url", F.lit("#again")), again, "revisit", F.lit(304), headers(
            again, F.when(page % 11 == 0, F.lit(None)).when(page % 7 == 0, F.lit('"other"')).otherwise(weak(content)), F.when(page % 2 == 0, F.lit("monday")).when(page % 3 == 0, F.lit("friday")), 60 * (1 + page % 5), F.lit(0))),
        row(2, section, at, "response", F.lit(200), headers(at, F.when(page % 6 != 0, state(at)), version(at), F.lit(60), length)),
        row(3, section, asked, "revisit", F.lit(304), headers(asked, F.when(page % 10 != 0, weak(state(asked))), version(asked), F.lit(120), F.lit(0))),
    )
    return pages.select("page_id", F.explode(every).alias("c")).select("page_id", "c.*")


def op1_revisit_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_revisits(captures_of(table(spark, sf_dir, "pages")))
    lines = F.array_sort(F.transform(F.map_entries("merged_headers"), lambda e: F.concat_ws(": ", F.lower(e["key"]), e["value"])))
    known = lambda c: F.coalesce(c, F.lit(-1)).alias(c)
    return resolved.select("page_id", "record_id", "canonical_url", "outcome", known("response_id"), known("age"), F.array_join(lines, "\n").alias("merged_headers"))


def op2_pigeonhole_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op3_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = histogram_shards(table(spark, sf_dir, "documents"), n_shards=16)
    return placed.select(
        "doc_id",
        "size",
        F.crc32(text_of("text").cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def block_list() -> Iterator[str]:
    """The list's entries; which tenth of the numbers differs by domain and language."""
    for d, domain in enumerate(LIST_DOMAINS):
        for k, language in enumerate(LIST_LANGUAGES):
            for n in range((3 * d + k) % LIST_EVERY, LIST_NUMBERS, LIST_EVERY):
                yield f"{domain}/{language}/{n}"
    yield from LIST_HOSTS


def op4_sorted_digest_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = chain(URL_RULES, ((e, LISTED) for e in block_list()))
    return filter_urls(table(spark, sf_dir, "pages"), entries).select("page_id", "host", "path", "rule", "verdict")


def op5_checked_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    pii = F.col("pii")
    return found.select(
        "doc_id",
        *[count_of(pii, kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")],
        F.sha2(spans_text(pii, base_only=True).cast("binary"), 256).alias("base_sha256"),
        spans_text(pii).alias("spans"),
    )


def op6_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), carry=("doc_id",))
    return judged.select("doc_id", *METRICS, "base_failed", "rules_failed", "host_docs", "host_failed", F.round("host_rate", 9).alias("host_rate"), "kept")


def tree_of(docs: DataFrame) -> DataFrame:
    """The documents as files: a repository for each source, directories of 4,096 and of 64 ids, and of ids that end alike.

    One in eight is a licence file, and lies in the directory of 64 ids, in that of 4,096, or in the repository's, by turns.
    """
    doc = F.col("doc_id")
    step = lambda n: F.floor(doc / n).cast("string")
    is_file = doc % 8 == 0
    level = F.when(is_file, F.floor(doc / 8) % 3).otherwise(F.lit(-1))
    name = F.when(is_file, "LICENSE").otherwise(F.concat(F.lit("file"), doc.cast("string"), F.lit(".txt")))
    # concat_ws leaves out nulls.
    parts = (F.coalesce("source", F.lit("none")), F.when(level < 2, step(4096)), F.when(level < 1, step(64)), F.when(level < 0, F.concat(F.lit("d"), (doc % 5).cast("string"))), name)
    return docs.select("doc_id", "text", F.concat_ws("/", *parts).alias("path"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(tree_of(table(spark, sf_dir, "documents")), carry=("doc_id", "path"))
    return found.withColumn("cosine", F.round("cosine", 6))


def op8_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_encode(table(spark, sf_dir, "documents"), tokenizer_path())
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_pigeonring_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), carry=("doc_id",))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_hashed_ngram_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out("doc_id")))
    return predict(docs.drop("lang"), model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_revisit_asof": op1_revisit_asof,
    "op2_pigeonhole_leaks": op2_pigeonhole_leaks,
    "op3_histogram_sort": op3_histogram_sort,
    "op4_sorted_digest_array": op4_sorted_digest_array,
    "op5_checked_pii_spans": op5_checked_pii_spans,
    "op6_host_quality_rules": op6_host_quality_rules,
    "op7_license_scan": op7_license_scan,
    "op8_rank_array_bpe": op8_rank_array_bpe,
    "op9_pigeonring_simhash": op9_pigeonring_simhash,
    "op10_hashed_ngram_bayes": op10_hashed_ngram_bayes,
}


def _sql_entries() -> str:
    says = {RULE_ALLOW: "allow", RULE_BLOCK: "block"}
    return ", ".join([f"('{e}', '{says[k]}')" for e, k in URL_RULES] + [f"('{e}', 'listed')" for e in LIST_HOSTS])



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_URL_PARTS = r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)\??([^#]*)"
_CUES = CUES.replace("'", "''")
#: The gap between terms without look-around; inner dots stay, outer ones are trimmed.
_TERM_GAP = r"[^a-z0-9.]+"
_WORD_SPLIT = r"[\x20\x09-\x0D]+"



def _found(k: int, kind: str, pattern: str, ends: str = "") -> str:
    """Matches of a kind (r, k, kind, m, start, b): the text, where it is, and what lies before it back to the last one.

    With ``ends`` the pattern finds whole runs of characters, of which those that match ``ends`` count.
    """
    return f"""
        SELECT r, {k} AS k, '{kind}' AS kind, m, s AS start, substr(text, coalesce(lag(s + length(m)) OVER (PARTITION BY r ORDER BY s), 0) + 1, s - coalesce(lag(s + length(m)) OVER (PARTITION BY r ORDER BY s), 0)) AS b
        FROM (
            SELECT r, text, m, CAST(sum(length(b) + length(m)) OVER (PARTITION BY r ORDER BY i) - length(m) AS BIGINT) AS s
            FROM (SELECT r, text, unnest(ms) AS m, unnest(bs[: len(ms)]) AS b, unnest(range(len(ms))) AS i
                  FROM (SELECT r, text, regexp_extract_all(text, '{pattern}') AS ms, regexp_split_to_array(text, '{pattern}') AS bs FROM d WHERE regexp_matches(text, '{pattern}'))))
        {f"WHERE regexp_matches(m, '{ends}')" if ends else ""}"""


def _context(kind: str) -> str:
    words = next(k.words for k in KINDS if k.name == kind)
    return f"regexp_matches(lower(right(b, {CONTEXT})), '(^|[^a-z])(?:{words})')"


ORACLE_SQL: dict[str, str] = {
    "op1_revisit_asof": rf"""
        WITH base AS (
            SELECT page_id, 180 * (page_id // 3) AS taken, url, regexp_replace(url, '(?s)[0-9]+[^0-9/?#]*/?([?#].*)?$', '') AS section,
                   '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS content, strlen(coalesce(html, '')) AS size
            FROM pages),
        timed AS (SELECT *, taken + 30 + 86400 * (page_id % 3) AS again, taken + 60 * (page_id % 5) - 60 AS asked FROM base),
        captures AS (
            SELECT page_id, 4 * page_id AS id, true AS stored, url, taken, CASE WHEN page_id % 5 <> 0 THEN content END AS tag,
                   CASE WHEN page_id % 4 <> 0 THEN 'monday' END AS modified, 3600 AS age, size FROM timed WHERE page_id % 13 <> 0
            UNION ALL
            SELECT page_id, 4 * page_id + 1, false, url || '#again', again, CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"other"' ELSE content END,
                   CASE WHEN page_id % 2 = 0 THEN 'monday' WHEN page_id % 3 = 0 THEN 'friday' END, 60 * (1 + page_id % 5), 0 FROM timed
            UNION ALL
            SELECT page_id, 4 * page_id + 2, true, section, taken, CASE WHEN page_id % 6 <> 0 THEN '"s' || (taken // 21600) || '"' END, CAST(taken // 21600 AS VARCHAR), 60, size FROM timed
            UNION ALL
            SELECT page_id, 4 * page_id + 3, false, section, asked, CASE WHEN page_id % 10 <> 0 THEN '"s' || CAST(floor(asked / 21600) AS BIGINT) || '"' END,
                   CAST(CAST(floor(asked / 21600) AS BIGINT) AS VARCHAR), 120, 0 FROM timed),
        parts AS (
            SELECT * EXCLUDE (url),
                   regexp_replace(regexp_replace(translate(regexp_extract(url, '{_URL_PARTS}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^www[.]', ''), ':(80|443)$', '') AS host,
                   regexp_replace(regexp_extract(url, '{_URL_PARTS}', 2), '/+$', '') AS path,
                   list_sort(list_filter(string_split(regexp_extract(url, '{_URL_PARTS}', 3), '&'),
                       lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)='))) AS params
            FROM captures),
        canon AS (SELECT *, CASE WHEN host <> '' THEN host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS key FROM parts),
        pairs AS (
            SELECT r.*, s.id AS found, s.taken AS found_at, s.tag AS found_tag, s.modified AS found_modified, s.size AS found_size,
                   row_number() OVER (PARTITION BY r.id ORDER BY s.taken DESC NULLS LAST, s.id DESC) AS n
            FROM canon r LEFT JOIN canon s ON r.key = s.key AND s.stored AND s.taken < r.taken WHERE NOT r.stored),
        judged AS (
            SELECT *, CASE WHEN found IS NULL THEN 'orphan' WHEN tag IS NOT NULL AND found_tag IS NOT NULL THEN CASE WHEN tag = found_tag THEN 'resolved' ELSE 'mismatch' END
                           WHEN modified IS NOT NULL AND found_modified IS NOT NULL THEN CASE WHEN modified = found_modified THEN 'resolved' ELSE 'mismatch' END ELSE 'unverified' END AS outcome
            FROM pairs WHERE n = 1)
        SELECT page_id, id AS record_id, key AS canonical_url, outcome,
               CASE WHEN outcome = 'resolved' THEN found ELSE -1 END AS response_id,
               CASE WHEN outcome = 'resolved' THEN taken - found_at ELSE -1 END AS age,
               CASE WHEN outcome = 'resolved' THEN concat_ws(chr(10), 'cache-control: max-age=' || age, 'content-length: ' || found_size, 'content-type: text/html', 'date: ' || taken,
                   'etag: ' || coalesce(CASE WHEN tag LIKE '"other%' THEN tag ELSE 'W/' || tag END, found_tag), 'last-modified: ' || found_modified) END AS merged_headers
        FROM judged""",
    "op4_sorted_digest_array": rf"""
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
            FROM pages),
        entries(entry, says) AS (
            VALUES {_sql_entries()}
            UNION ALL
            SELECT domain || '/' || language || '/' || n, 'listed'
            FROM (VALUES {", ".join(f"({i}, '{d}')" for i, d in enumerate(LIST_DOMAINS))}) AS a(d, domain), (VALUES {", ".join(f"({i}, '{x}')" for i, x in enumerate(LIST_LANGUAGES))}) AS b(k, language),
                 (SELECT unnest(range({LIST_NUMBERS})) AS n) WHERE n % {LIST_EVERY} = (3 * d + k) % {LIST_EVERY}),
        cut AS (SELECT entry, says, split_part(entry, '/', 1) AS on_host, substr(entry, strpos(entry, '/')) AS on_path FROM entries),
        fits AS (
            SELECT page_id, says, entry, row_number() OVER (PARTITION BY page_id, says = 'listed' ORDER BY length(entry) DESC, length(on_host) DESC) AS n
            FROM parts JOIN cut ON (host = on_host OR ends_with(host, '.' || on_host)) AND starts_with(path, on_path))
        SELECT p.page_id, host, path, r.entry AS rule,
               CASE WHEN r.says IS NOT NULL THEN r.says WHEN l.page_id IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
        FROM parts p
        LEFT JOIN fits r ON r.page_id = p.page_id AND r.says <> 'listed' AND r.n = 1
        LEFT JOIN fits l ON l.page_id = p.page_id AND l.says = 'listed' AND l.n = 1""",
    "op5_checked_pii_spans": rf"""
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        raw AS ({_found(0, "email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+")}
            UNION ALL {_found(1, "ip", "[0-9]+([.][0-9]+)([.][0-9]+)([.][0-9]+)")}
            UNION ALL {_found(2, "card", "[0-9]([ -]?[0-9])+")}
            UNION ALL {_found(3, "phone", "[+][0-9][ ().0-9-]+[0-9]")}
            UNION ALL {_found(5, "ssn", "[A-Za-z0-9-]+", ends="^[0-9]{3}-[0-9]{2}-[0-9]{4}$")}
            UNION ALL {_found(6, "secret", "[A-Za-z0-9]+", ends="^[0-9a-f]{32,64}$")}),
        begins AS ({_found(4, "iban", "[A-Za-z0-9]+", ends="^[A-Z]{2}[0-9]{2}")}),
        ibans AS (
            SELECT r, start, m, row_number() OVER (PARTITION BY r ORDER BY start) AS n
            FROM (SELECT r, text, start, regexp_extract(substr(text, start + 1), '^[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}}') AS m FROM begins JOIN d USING (r))
            WHERE m <> '' AND NOT regexp_matches(substr(text, start + length(m) + 1, 1), '[A-Za-z0-9]')),
        apart(r, n, start, m, upto, taken) AS (
            SELECT r, n, start, m, start + length(m), true FROM ibans WHERE n = 1
            UNION ALL
            SELECT i.r, i.n, i.start, i.m, CASE WHEN i.start >= a.upto THEN i.start + length(i.m) ELSE a.upto END, i.start >= a.upto FROM apart a JOIN ibans i ON i.r = a.r AND i.n = a.n + 1),
        moved AS (SELECT r, start, m, regexp_extract(replace(m, ' ', ''), '^.{{4}}(.*)$', 1) || substr(replace(m, ' ', ''), 1, 4) AS t FROM apart WHERE taken),
        mod97(r, start, m, t, i, rest) AS (
            SELECT r, start, m, t, 0, 0 FROM moved
            UNION ALL
            SELECT r, start, m, t, i + 1, CASE WHEN substr(t, i + 1, 1) BETWEEN '0' AND '9' THEN (rest * 10 + ascii(substr(t, i + 1, 1)) - 48) % 97 ELSE (rest * 100 + ascii(substr(t, i + 1, 1)) - 55) % 97 END
            FROM mod97 WHERE i < length(t)),
        digits AS (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS ds FROM raw),
        spans AS (
            SELECT r, k, kind, start, start + length(m) AS stop FROM digits
            WHERE CASE kind
                WHEN 'email' THEN true
                WHEN 'ip' THEN list_bool_and(list_transform(string_split(m, '.'), lambda x: coalesce(TRY_CAST(x AS BIGINT) <= 255, false)))
                WHEN 'card' THEN length(ds) BETWEEN 16 AND 19 AND list_sum(list_transform(range(length(ds)), lambda j:
                    CAST(substr(ds, length(ds) - j, 1) AS INTEGER) * (1 + j % 2) - CASE WHEN j % 2 = 1 AND substr(ds, length(ds) - j, 1) > '4' THEN 9 ELSE 0 END)) % 10 = 0
                WHEN 'phone' THEN length(ds) BETWEEN 8 AND 15
                WHEN 'ssn' THEN NOT regexp_matches(m, '^(?:000|666|9..)|-00-|-0000$') AND {_context("ssn")}
                ELSE {_context("secret")} END
            UNION ALL SELECT r, 4, 'iban', start, start + length(m) FROM mod97 WHERE i = length(t) AND rest = 1),
        listed AS (
            SELECT r, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) AS spans, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) FILTER (WHERE k < 4) AS base,
                   count(*) FILTER (WHERE k = 0) AS n_email, count(*) FILTER (WHERE k = 1) AS n_ip, count(*) FILTER (WHERE k = 2) AS n_card, count(*) FILTER (WHERE k = 3) AS n_phone
            FROM spans GROUP BY r)
        SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN listed USING (r)""",
    "op6_host_quality_rules": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '{_WORD_SPLIT}'), lambda w: w <> '') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
            FROM documents),
        windows AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
        repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM windows) WHERE c >= 2),
        covered AS (SELECT r, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) AS t(k) GROUP BY r),
        measured AS (
            SELECT d.r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(text, '{_WORD_SPLIT}', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
            FROM d LEFT JOIN covered c ON c.r = d.r),
        failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                          100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 50 * n_lines OR word_chars NOT BETWEEN 3 * n_words AND 10 * n_words AS soft_failed FROM measured),
        judged AS (SELECT *, base_failed OR soft_failed AS rules_failed FROM failed),
        hosts AS (SELECT source, count(*) AS n, CAST(count(*) FILTER (WHERE rules_failed) AS BIGINT) AS f FROM judged GROUP BY source),
        moments AS (SELECT sum(n)::DOUBLE AS n, sum(f)::DOUBLE / sum(n) AS m, count(*) AS k, sum(f * f / n::DOUBLE) AS ff_n, sum(n * n)::DOUBLE AS nn FROM hosts),
        spread AS (SELECT m, m * (1 - m) AS within, ((ff_n - n * m * m) - (k - 1) * m * (1 - m)) / greatest(n - nn / n, 1e-9) AS between FROM moments),
        prior AS (SELECT m, CASE WHEN between > 0 AND within > 0 THEN least(greatest(within / between - 1, 2.0), 1000.0) ELSE 1000.0 END AS s FROM spread),
        rates AS (SELECT source, n, f, (f + m * s) / (n + s) AS rate FROM hosts, prior)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rules_failed, n AS host_docs, f AS host_failed, round(rate, 9) AS host_rate,
               NOT rules_failed AND rate < 0.5 AS kept
        FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source""",
    "op7_license_scan": rf"""
        WITH RECURSIVE templates(template, licence, text) AS (VALUES {", ".join(f"({n}, {_quoted(a)}, {_quoted(b)})" for n, (a, b) in enumerate(TEMPLATES))}),
        vectors AS (
            SELECT template, licence, term, count(*) AS tf
            FROM (SELECT template, licence, unnest(regexp_split_to_array(lower(text), '{_TERM_GAP}')) AS raw FROM templates), LATERAL (SELECT trim(raw, '.') AS term)
            WHERE term <> '' GROUP BY ALL),
        files AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, doc_id % 8 = 0 AS is_file,
                   coalesce(source, 'none') || CASE WHEN doc_id % 8 <> 0 OR doc_id // 8 % 3 < 2 THEN '/' || (doc_id // 4096) ELSE '' END
                       || CASE WHEN doc_id % 8 <> 0 OR doc_id // 8 % 3 < 1 THEN '/' || (doc_id // 64) ELSE '' END || CASE WHEN doc_id % 8 <> 0 THEN '/d' || (doc_id % 5) ELSE '' END AS dir
            FROM documents),
        cued AS (SELECT *, string_split(text, chr(10)) AS lines FROM files WHERE regexp_matches(text, '{_CUES}')),
        spots AS (SELECT r, lines, i FROM (SELECT r, lines, unnest(range(1, len(lines) + 1)) AS i FROM cued) WHERE regexp_matches(lines[i], '{_CUES}')),
        units AS (
            SELECT r, array_to_string(lines[greatest(i + back, 1) : greatest(i + back, 1) + n - 1], chr(10)) AS unit FROM spots, (VALUES {", ".join(f"({at}, {n})" for at, n in WINDOWS)}) AS w(back, n)
            UNION SELECT r, text FROM cued WHERE is_file),
        counts AS (
            SELECT r, unit, term, count(*) AS tf
            FROM (SELECT r, unit, unnest(regexp_split_to_array(lower(unit), '{_TERM_GAP}')) AS raw FROM units), LATERAL (SELECT trim(raw, '.') AS term)
            WHERE term <> '' GROUP BY ALL),
        total AS (SELECT count(*)::DOUBLE AS n FROM cued),
        df AS (SELECT term, count(DISTINCT r) AS df FROM counts GROUP BY term),
        weighted AS (SELECT template, licence, v.term, tf * (ln((1 + n) / (1 + coalesce(df, 0))) + 1) AS w FROM vectors v LEFT JOIN df ON df.term = v.term, total),
        lengths AS (SELECT template, sqrt(sum(w * w)) AS length FROM weighted GROUP BY template),
        mine AS (SELECT r, unit, c.term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM counts c JOIN df ON df.term = c.term, total),
        norms AS (SELECT r, unit, sqrt(sum(w * w)) AS norm FROM mine GROUP BY r, unit),
        scored AS (
            SELECT m.r, v.licence, round(sum(m.w * v.w) / any_value(l.length) / any_value(norm), 9) AS cosine
            FROM mine m JOIN weighted v USING (term) JOIN lengths l USING (template) JOIN norms USING (r, unit) GROUP BY m.r, m.unit, v.template, v.licence),
        own AS (SELECT r, licence, cosine FROM scored WHERE cosine >= {MIN_COSINE} QUALIFY row_number() OVER (PARTITION BY r ORDER BY cosine DESC, licence) = 1),
        judged AS (SELECT f.*, licence, cosine FROM files f LEFT JOIN own USING (r)),
        licensed AS (SELECT dir, licence, cosine FROM judged WHERE is_file AND licence IS NOT NULL QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, licence) = 1),
        ancestors(dir, above, up) AS (
            SELECT DISTINCT dir, dir, 0 FROM files
            UNION ALL
            SELECT dir, CASE WHEN contains(above, '/') THEN regexp_replace(above, '/[^/]*$', '') ELSE '' END, up + 1 FROM ancestors WHERE above <> ''),
        near AS (SELECT a.dir, l.dir AS from_dir, licence, cosine FROM ancestors a JOIN licensed l ON l.dir = a.above QUALIFY row_number() OVER (PARTITION BY a.dir ORDER BY up) = 1)
        SELECT j.doc_id, j.dir || CASE WHEN is_file THEN '/LICENSE' ELSE '/file' || j.doc_id || '.txt' END AS path, coalesce(j.licence, d.licence) AS license, round(coalesce(j.cosine, d.cosine), 6) AS cosine,
               CASE WHEN j.licence IS NOT NULL THEN CASE WHEN is_file THEN 'file' ELSE 'header' END WHEN d.dir IS NOT NULL THEN 'inherited' END AS via,
               CASE WHEN j.licence IS NULL THEN d.from_dir END AS from_dir
        FROM judged j LEFT JOIN near d ON d.dir = j.dir""",
}
