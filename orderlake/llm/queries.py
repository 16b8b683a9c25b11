"""The queries of the operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (bagminhash, deep_shallow, extendible, importance, kneser_ney, licences, line_hash, periodic, pieces,
               sentence_spans, spectrum, tiling, wavelet)
from .common import read

#: The vocabulary files, installed with their package.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_wavelet_tokens(spark, sf_dir):
    shards = wavelet.write_token_shards(read(spark, sf_dir, "documents"), WORD_BPE)
    return wavelet.token_documents(shards)


def op2_sentence_spans(spark, sf_dir):
    return sentence_spans.remove_repeated_spans(read(spark, sf_dir, "documents"))


def op3_deep_shallow(spark, sf_dir):
    return deep_shallow.remove_repeats(read(spark, sf_dir, "documents"))


def op4_bagminhash(spark, sf_dir):
    return bagminhash.near_duplicates(read(spark, sf_dir, "documents"))


def op5_importance(spark, sf_dir):
    return importance.select_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_licence_scan(spark, sf_dir):
    found = licences.scan(licences.document_files(read(spark, sf_dir, "documents")))
    return found.withColumnRenamed("file_id", "doc_id")


def op7_string_tiling(spark, sf_dir):
    return tiling.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_kneser_ney(spark, sf_dir):
    return kneser_ney.train_and_score(read(spark, sf_dir, "documents"), add_one=True)


def op9_piece_rounds(spark, sf_dir):
    return pieces.piece_digests(read(spark, sf_dir, "documents"), PIECE_BPE)


def op10_extendible_hash(spark, sf_dir):
    return extendible.exact_groups(read(spark, sf_dir, "documents"))


def op11_spectrum_slicing(spark, sf_dir):
    return spectrum.whiten(spectrum.fixed_point(read(spark, sf_dir, "embeddings")))


def op12_line_hash(spark, sf_dir):
    left = line_hash.remove_repeated_lines(read(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_periodic_runs(spark, sf_dir):
    docs = periodic.with_planted_loops(read(spark, sf_dir, "documents"))
    return periodic.run_digests(periodic.collapse_runs(docs))


QUERIES = {q.__name__: q for q in (op1_wavelet_tokens, op2_sentence_spans, op3_deep_shallow, op4_bagminhash, op5_importance,
                                   op6_licence_scan, op7_string_tiling, op8_kneser_ney, op9_piece_rounds,
                                   op10_extendible_hash, op11_spectrum_slicing, op12_line_hash, op13_periodic_runs)}

ORACLES = {
    "op10_extendible_hash": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_line_hash": r"""
        WITH lines AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
          FROM documents
        ), keyed AS (
          SELECT *, translate(trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM lines
        ), counted AS (
          SELECT key, count(DISTINCT doc_id) AS docs, max(doc_id) AS last
          FROM keyed WHERE length(key) >= 40 GROUP BY key
        ), judged AS (
          SELECT k.*, coalesce(c.docs >= 5 AND c.last <> k.doc_id, false) AS gone
          FROM keyed k LEFT JOIN counted c USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
}
