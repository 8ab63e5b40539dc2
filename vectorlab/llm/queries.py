"""Registered queries of the text operators and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from ..session import scratch_path
from . import common as C
from . import centroids, collocations, decontaminate, exact_dedup, html_text, license_scan, minhash, mixing, packing, simhash, suffix_dedup, toxicity, training_order


def _documents(spark, sf_dir):
    return C.table(spark, sf_dir, "documents")


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op2_training_order(spark, sf_dir):
    return training_order.training_order(_documents(spark, sf_dir), scratch_path(spark, "training-order"))


def op3_lm_scoring(spark, sf_dir):
    return mixing.score(_documents(spark, sf_dir))


def op4_license_scan(spark, sf_dir):
    return license_scan.licences(_documents(spark, sf_dir))


def op5_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(_documents(spark, sf_dir))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir))


def op7_toxicity(spark, sf_dir):
    return toxicity.toxicity(_documents(spark, sf_dir), C.table(spark, sf_dir, "labels"))


def op8_packing(spark, sf_dir):
    return packing.pack(_documents(spark, sf_dir))


def op9_html_extraction(spark, sf_dir):
    return html_text.extract(C.table(spark, sf_dir, "pages"))


def op10_decontamination(spark, sf_dir):
    return decontaminate.contamination(_documents(spark, sf_dir), C.table(spark, sf_dir, "benchmark"))


def op11_minhash(spark, sf_dir):
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op12_centroids(spark, sf_dir):
    return centroids.clusters(C.table(spark, sf_dir, "embeddings"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(_documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_training_order, op3_lm_scoring, op4_license_scan, op5_suffix_dedup, op6_exact_dedup, op7_toxicity, op8_packing,
    op9_html_extraction, op10_decontamination, op11_minhash, op12_centroids, op13_collocations)}

ORACLES = {
    "op11_minhash": minhash.sql(),
    "op12_centroids": centroids.sql(),
    "op13_collocations": collocations.sql(),
    "op4_license_scan": license_scan.sql(),
    "op6_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op10_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bw AS (SELECT item_id, least(len(w), 10) AS n, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0),
        win AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS s FROM bw),
        sizes AS (SELECT DISTINCT n FROM win),
        dp AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
        dw AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS s FROM dp, sizes WHERE p + n - 1 <= len(w)),
        m AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN win ON dw.n = win.n AND dw.s = win.s),
        h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
        i AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN i ON d.doc_id = i.doc_id""",
}
