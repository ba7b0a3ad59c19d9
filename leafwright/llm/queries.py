"""Queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafwright.llm import leaks, lookalike, markup, packing, pieces, records, residue, scans
from leafwright.runtime import table


def p1_found(spark, folder):
    return lookalike.same_look_pairs(records.title_records(table(spark, folder, "blocks"), table(spark, folder, "trees")))


def p1_classes(spark, folder):
    """A row per record whose form is stored in several ways: its document, the class of its stored text and of its form."""
    c = lookalike.same_look_classes(records.title_records(table(spark, folder, "blocks"), table(spark, folder, "trees")))
    return c.select("doc_id", F.sha2("form", 256).alias("form_class"), F.sha2("text", 256).alias("text_class"), "rec_key")


def p1_forms(spark, folder):
    """Every block content and tree title in its consistent form."""
    blocks, trees = table(spark, folder, "blocks"), table(spark, folder, "trees")
    b = blocks.select(records.block_key().alias("rec_key"), F.col("content").alias("text"))
    t = records.title_records(blocks.limit(0), trees).select("rec_key", "text")
    return lookalike.normalize_texts(b.unionByName(t), "text").select("rec_key", "form")


def p2_found(spark, folder):
    return scans.noisy_records(table(spark, folder, "blocks"), table(spark, folder, "trees"))


def p2_repaired(spark, folder):
    return scans.repaired(table(spark, folder, "blocks"), table(spark, folder, "trees"))


def p4_found(spark, folder):
    return pieces.oversized(table(spark, folder, "sub_com_trees"), table(spark, folder, "size_limits"))


def p4_pieces(spark, folder):
    return pieces.node_pieces(table(spark, folder, "sub_com_trees"), table(spark, folder, "size_limits"))


def p6_containers(spark, folder):
    return packing.packed_documents(table(spark, folder, "documents"), table(spark, folder, "size_limits"))


def p5_found(spark, folder):
    return markup.markup_formats(records.text_records(table(spark, folder, "blocks"), table(spark, folder, "trees")))


def p5_clean(spark, folder):
    return markup.cleaned(records.text_records(table(spark, folder, "blocks"), table(spark, folder, "trees")))


def p5_paths(spark, folder):
    r = records.text_records(table(spark, folder, "blocks"), table(spark, folder, "trees"))
    return markup.scored_paths(markup.path_ratios(markup.path_counts(r)))


def p7_found(spark, folder):
    found = leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))
    return found.filter(F.col("run") >= leaks.MIN_WORDS).select("doc_id", "item_id")


def p7_leaks(spark, folder):
    return leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p8_found(spark, folder):
    return residue.residues(table(spark, folder, "documents")).select("doc_id").distinct()


def p8_templates(spark, folder):
    return residue.mined_templates(table(spark, folder, "documents"))


def queries():
    found = (p1_found, p2_found, p4_found, p5_found, p7_found, p8_found)
    more = (p1_classes, p1_forms, p2_repaired, p4_pieces, p5_clean, p5_paths, p6_containers, p7_leaks, p8_templates)
    return {f.__name__: f for f in found + more}


def oracle_sql():
    return {
        "p4_found": """
            SELECT DISTINCT node_key FROM sub_com_trees JOIN size_limits USING (node_type)
            WHERE table_name = 'sub_com_trees' AND size_unit = 'characters'
              AND length(replace(replace(content, '<|txt_split|>', ''), '<|txt_contd|>', '')) > max_size""",
    }
