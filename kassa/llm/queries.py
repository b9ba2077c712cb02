"""Registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kassa.llm import (alignment, bpe, decontaminate, exact_dedup, langid, licenses, line_dedup, merkle, near_dedup, quality, secret_scan, suffix_dedup,
                       url_reputation)
from kassa.llm.common import read_table

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole document by the byte-level convolutional network."""
    return quality.quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document by hyperdimensional profiles."""
    return langid.language_report(read_table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document by the tokenization automaton, and their decoding."""
    return bpe.token_digests(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url by rules and host reputation."""
    return url_reputation.url_verdicts(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that also start earlier."""
    return suffix_dedup.repeat_digests(read_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents by block naming; the largest doc_id stays."""
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicate documents by weighted sampling over TF-IDF shingles."""
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, documents and notices within or across lines that state one of the licences."""
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"), windows=True)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share, taken out of every document."""
    return line_dedup.line_digests(read_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a benchmark item, or of a passage of one, in a document, within the edit budget."""
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                      segment_words=decontaminate.SEGMENT_WORDS)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaf, roots and proof of every document, and which proofs later changes break."""
    return merkle.manifest_report(read_table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies aligned in every whole document, with the corpus counts of their links."""
    return alignment.align_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path(PIECES))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole document, found once for each different content."""
    return secret_scan.secret_report(read_table(spark, sf_dir, "documents"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_language": op2_language,
    "op3_bpe": op3_bpe,
    "op4_url_filter": op4_url_filter,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_licenses": op8_licenses,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_merkle": op11_merkle,
    "op12_alignment": op12_alignment,
    "op13_secrets": op13_secrets,
}

def license_sql(least: float = licenses.LEAST) -> str:
    """SQL twin of the licence scan: the templates' words are cut by SQL itself."""
    values = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in licenses.TEMPLATES)

    def words(text: str) -> str:
        return f"list_filter(string_split(trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '), lambda x: x <> '')"

    def grams(w: str) -> str:
        return f"list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"

    return f"""
        WITH t AS (SELECT license, {grams('w')} AS tg FROM (SELECT c0 AS license, {words('c1')} AS w FROM (VALUES {values}) v(c0, c1))),
        d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        u AS (SELECT doc_id, generate_subscripts(ls, 1) AS line, unnest(ls) AS text FROM d
              UNION ALL SELECT doc_id, 0, text FROM d WHERE len(ls) > 1),
        g AS (SELECT doc_id, line, text, {grams('w')} AS ug FROM (SELECT *, {words('text')} AS w FROM u) WHERE len(w) > 1),
        s AS (SELECT doc_id, line, license, 2.0::DOUBLE * len(list_intersect(ug, tg)) / (len(ug) + len(tg)) AS dice,
                     CASE WHEN line > 0 THEN text END AS text
              FROM g, t WHERE 2.0 * least(len(ug), len(tg)) >= {least} * (len(ug) + len(tg)))
        SELECT doc_id, line::INTEGER AS line, license, dice, text FROM s WHERE dice >= {least}"""


def url_sql(max_bad: float = url_reputation.MAX_BAD, z: float = url_reputation.Z) -> str:
    """SQL twin of the url filter."""
    two = ", ".join(f"'{x}'" for x in url_reputation.TWO_LABEL_SUFFIXES)
    upper, lower = url_reputation.UPPER, url_reputation.LOWER
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_reputation.RULES)

    def strength(name: str, source: str) -> str:
        return f"""{name} AS (SELECT CASE WHEN g < 2 OR n <= g OR s = 0 OR s = n THEN 100.0
            ELSE 1 / least(0.99, greatest(0.001, coalesce((msb - msw) / (msb + (each - 1) * msw), 0.001))) - 1 END AS k FROM (
            SELECT g, n, s, (ss - s * s / n) / nullif(g - 1, 0) AS msb, (s - ss) / nullif(n - g, 0) AS msw, (n - nn / n) / nullif(g - 1, 0) AS each
            FROM (SELECT count(*)::DOUBLE AS g, sum(n)::DOUBLE AS n, sum(s)::DOUBLE AS s, sum(s * s / n::DOUBLE) AS ss, sum((n * n)::DOUBLE) AS nn FROM {source})))"""

    return f"""
        WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{upper}', '{lower}') AS host,
                          regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        o AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
              WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
        h AS (SELECT host, array_to_string(list_slice(parts, -2, -1), '.') AS two, parts, n, s FROM (
              SELECT host, string_split(host, '.') AS parts, count(*) AS n, sum(bad) AS s FROM p JOIN o ON page_id = doc_id GROUP BY host)),
        hosts AS (SELECT host, n, s, CASE WHEN two IN ({two}) THEN array_to_string(list_slice(parts, -3, -1), '.') ELSE two END AS domain,
                         CASE WHEN two IN ({two}) THEN two ELSE parts[-1] END AS suffix FROM h),
        domains AS (SELECT domain, suffix, sum(n) AS n, sum(s) AS s FROM hosts GROUP BY ALL),
        suffixes AS (SELECT suffix, sum(n) AS n, sum(s) AS s FROM domains GROUP BY ALL),
        {strength('kh', 'hosts')}, {strength('kd', 'domains')}, {strength('ks', 'suffixes')},
        m0 AS (SELECT (sum(s) + 1) / (sum(n) + 2) AS m FROM suffixes),
        ms AS (SELECT suffix, (k * m + s) / (k + n) AS m FROM suffixes, ks, m0),
        md AS (SELECT domain, suffix, (k * m + s) / (k + n) AS m FROM domains JOIN ms USING (suffix), kd),
        mh AS (SELECT host, k * m + s AS a, k * (1 - m) + n - s AS b FROM hosts JOIN md USING (domain, suffix), kh),
        blocked AS (SELECT host FROM mh WHERE a / (a + b) - {z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > {max_bad}),
        r AS (SELECT page_id, host, path, v, rh || rp AS rule,
                     row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rh || rp) DESC, length(rh) DESC, v DESC) AS k
              FROM (SELECT DISTINCT * FROM p), (VALUES {rules}) t(v, rh, rp)
              WHERE (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp))
        SELECT p.page_id, p.host, p.path, r.rule, CASE WHEN r.rule IS NOT NULL THEN r.v
               WHEN p.host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict
        FROM p LEFT JOIN r ON r.k = 1 AND p.page_id IS NOT DISTINCT FROM r.page_id AND p.host = r.host AND p.path = r.path"""


ORACLE: dict[str, str] = {
    "op4_url_filter": url_sql(),
    "op8_licenses": license_sql(),
    "op11_merkle": merkle.manifest_sql(),
    "op13_secrets": secret_scan.secret_sql(),
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op9_line_dedup": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        l AS (SELECT r, doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM d),
        k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
        m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY r, doc_id""",
}
