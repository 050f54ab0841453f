"""One registered query per corpus operator, with production parameters.

Each is ``(spark, sf_dir) -> DataFrame`` over its whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.llm.common import table
from tillroll.session import scratch_path


def op1_private_data(spark, d):
    from tillroll.llm.pii import digest, private_spans
    return digest(private_spans(table(spark, d, "documents")))


def op2_huffman_ids(spark, d):
    from tillroll.llm.huffman import read_digests, write_ids
    path = scratch_path(spark, "huffman-ids")
    write_ids(table(spark, d, "documents"), path, end_id=1)
    return read_digests(spark, path)


def op3_exact_topk(spark, d):
    from tillroll.llm.topk import topk
    vectors = table(spark, d, "embeddings")
    return topk(vectors, vectors.where(F.pmod("vec_id", F.lit(100)) == 0), k=10, scale=1024.0)


def op4_secret_scan(spark, d):
    from tillroll.llm.secret_scan import digest, secret_spans
    return digest(secret_spans(table(spark, d, "documents")))


def op5_url_filter(spark, d):
    from tillroll.llm.url_filter import LIST_TERMS, RULES, listed_by_terms, url_filter
    pages = table(spark, d, "pages")
    return url_filter(pages, listed_by_terms(pages, LIST_TERMS), RULES)


def op6_jaccard_join(spark, d):
    from tillroll.llm.jaccard import near_duplicates
    return near_duplicates(table(spark, d, "documents"), k=3, percent=90)


def op7_benchmark_copies(spark, d):
    from tillroll.llm.decontam import benchmark_copies
    return benchmark_copies(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op8_best_fit_packing(spark, d):
    from tillroll.llm.packing import pack_documents
    return pack_documents(table(spark, d, "documents"), width=2048, end_id=0)


def op9_string_kernel_toxicity(spark, d):
    from tillroll.llm.toxicity import toxicity
    return toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


def op10_edit_counts(spark, d):
    from tillroll.llm.edit_counts import edit_counts
    return (edit_counts(table(spark, d, "documents"))
            .select("doc_id", "n_edits", "tokens_before", "tokens_after", "chars_after", "chars_encoded"))


def op11_spelling_variants(spark, d):
    from tillroll.llm.variants import count_words, distorted, variants
    return variants(count_words(table(spark, d, "documents"), letters=7, least=2, alter=distorted), times=10)


def op12_simhash_join(spark, d):
    from tillroll.llm.simhash import near_duplicates
    return near_duplicates(table(spark, d, "documents"), k=4, errors=4)


def op13_periodic_runs(spark, d):
    from tillroll.llm.periodic import digest, echoed, periodic_runs
    return digest(periodic_runs(table(spark, d, "documents"), least=24, times=3, alter=echoed))


QUERIES = {f.__name__: f for f in (
    op1_private_data,
    op2_huffman_ids,
    op3_exact_topk,
    op4_secret_scan,
    op5_url_filter,
    op6_jaccard_join,
    op7_benchmark_copies,
    op8_best_fit_packing,
    op9_string_kernel_toxicity,
    op10_edit_counts,
    op11_spelling_variants,
    op12_simhash_join,
    op13_periodic_runs,
)}
