"""The queries of this subpackage and the DuckDB SQL that some of them are held against."""

from __future__ import annotations

from quern.llm import decontamination, html_extraction, licenses, line_dedup, mixing, near_dedup, quality, secrets, token_counts, warc

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_html_extraction": html_extraction.op4_html_extraction,
    "op5_mixing": mixing.op5_mixing,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_quality_rules": quality.op7_quality_rules,
    "op8_warc": warc.op8_warc,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_line_dedup": line_dedup.op10_line_dedup,
}

#: Columns of those queries that SQL can say.
QUERIES |= {
    "q_op1_bytes": lambda s, d: token_counts.op1_token_counts(s, d).select("doc_id", "n_bytes"),
    "q_op3_base": lambda s, d: secrets.op3_secret_scan(s, d).select("doc_id", "n_assign", "n_access", "n_hex"),
    "q_op5_sizes": lambda s, d: mixing.op5_mixing(s, d).select("doc_id", "size", "source_size"),
    "q_op7_base": lambda s, d: quality.op7_quality_rules(s, d).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"),
}

ORACLES: dict[str, str] = {
    "q_op1_bytes": "SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM documents",
    "q_op3_base": r"""SELECT doc_id, len(list_filter(regexp_extract_all(coalesce(text, ''), '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 8))::BIGINT AS n_assign,
        len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 16))::BIGINT AS n_access, len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 32))::BIGINT AS n_hex FROM documents""",
    "q_op5_sizes": r"""WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents), t AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY 1)
        SELECT doc_id, size, source_size FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source""",
    "q_op7_base": r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        l AS (SELECT r, list_filter(string_split(x, chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS ls FROM d), p AS (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d),
        g AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i : i + 4]) AS c FROM p), u AS (SELECT r, count(DISTINCT i + k) AS n FROM g, range(5) AS t(k) WHERE c > 1 GROUP BY 1)
        SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars, length(regexp_replace(x, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
            coalesce(u.n, 0)::BIGINT AS n_repeat_words, len(w) < 10 OR 100 * coalesce(u.n, 0) > 20 * len(w) AS base_failed FROM d JOIN l USING (r) LEFT JOIN u USING (r)""",
    "op6_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]] ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
        e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
        r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
        SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(min(r.b), w.doc_id)) AS component_id,
               w.doc_id = least(w.doc_id, coalesce(min(r.b), w.doc_id)) AS kept
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = w.doc_id GROUP BY w.doc_id""",
    "op8_warc": warc.ORACLE,
}
