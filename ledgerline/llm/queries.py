"""Registered queries: each applies one operator to its whole table. ``QUERIES``: name -> (run, sql)."""

from __future__ import annotations

import public_tokenizers

from ledgerline.llm import (
    alignment,
    bwt_merge,
    byte_bpe,
    decontaminate,
    histogram_sort,
    merkle,
    mixing,
    noisy_channel,
    odd_sketch,
    pii,
    quality_rules,
    recompression,
    reply_trees,
)
from ledgerline.llm.common import table

W = r"[\x20\x09-\x0D]+"


def op1_histogram_sort(spark, sf_dir):
    return histogram_sort.report(table(spark, sf_dir, "documents"))


def op2_reply_trees(spark, sf_dir):
    return reply_trees.report(table(spark, sf_dir, "conversations"))


def op3_simhash_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_odd_sketch_dedup(spark, sf_dir):
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"))


def op5_pii_spans(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    return quality_rules.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_recompression_dedup(spark, sf_dir):
    return recompression.dedup_substrings(table(spark, sf_dir, "documents"))


def op9_noisy_channel_toxicity(spark, sf_dir):
    return noisy_channel.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_bwt_merge_dedup(spark, sf_dir):
    return bwt_merge.dedup_bytes(table(spark, sf_dir, "documents"))


def op11_segment_tree_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.report(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op12_fragment_alignment(spark, sf_dir):
    models = alignment.read_models(
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.PATTERN,
    )
    return alignment.report(table(spark, sf_dir, "documents"), models)


def op13_interval_manifest(spark, sf_dir):
    return merkle.report(table(spark, sf_dir, "documents"))


def _escaped_length(x: str, controls: tuple[str, ...]) -> str:
    out = rf"replace({x}, '\', '\\')"
    for c in controls:
        out = rf"replace({out}, '{c}', '\{c}')"
    return f"length({out})"


OP2_SQL = rf"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, i, ['user', 'assistant'][i + 1], '{reply_trees.CONTROL}' from range(2) r(i)),
c as (
  select conv_id, count(*)::bigint as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as body,
    coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '') as loss,
    sum(15 + {_escaped_length("role", ("###", "</turn>", ":"))}
      + {_escaped_length("text", ("###", "</turn>"))})::bigint as formatted_chars
  from t group by 1)
select conv_id, n_turns, sha256(body) as turns_sha256, length(loss)::bigint as loss_chars,
  sha256(loss) as loss_sha256, formatted_chars
from c"""

OP4_SQL = rf"""
with recursive d as (
  select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{W}'), lambda x: x <> '') as w
  from documents),
g as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from g group by 1),
both_ as (select a.doc_id as a, b.doc_id as b, count(*) as c
  from g a join g b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
link as (select a, b from both_ join n x on a = x.doc_id join n y on b = y.doc_id
  where 100 * c >= 85 * (x.n + y.n - c)),
reach(id, seen) as (
  select doc_id, doc_id from d
  union
  select reach.id, link.b from reach join link on link.a = reach.seen)
select d.doc_id, coalesce(n.n, 0) as n_shingles, min(seen) as component_id, d.doc_id = min(seen) as kept
from d left join n using (doc_id) join reach on reach.id = d.doc_id
group by d.doc_id, n.n"""


def _quality_counts(source: str) -> str:
    """CTEs up to ``counts`` over a relation with the columns of documents."""
    stops = ", ".join("'" + w + "'" for w in sorted(set(quality_rules.STOP_WORDS)))
    return rf"""
d as (select *, coalesce(text, '') as body,
  list_filter(string_split_regex(coalesce(text, ''), '{W}'), lambda x: x <> '') as w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from {source}),
grams as (select doc_id, i, [w[i], w[i + 1], w[i + 2]] as s
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)),
again as (select doc_id, i, count(*) over (partition by doc_id, s) as n from grams),
covered as (select doc_id, count(distinct i + k) as n
  from (select doc_id, i, unnest([0, 1, 2]) as k from again where n > 1) group by 1),
counts as (select d.*, len(w)::bigint as n_words,
  coalesce(length(array_to_string(w, '')), 0)::bigint as word_chars,
  length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
  (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
  coalesce(covered.n, 0)::bigint as n_repeat_words, len(lines) as n_lines,
  length(body) - length(replace(body, '!', '')) as n_shouts,
  len(list_filter(w, lambda x: lower(x) in ({stops}))) as n_stop_words
  from d left join covered using (doc_id))"""


FAILED = "(n_words < 50 or 100 * n_repeat_words > 50 * n_words)"
PASSES = " and ".join(
    f"coalesce({r.numerator}::double / nullif({r.denominator}, 0), 0) between {r.low} and {r.high}"
    for r in quality_rules.RULES
)
OP7_SQL = f"""with {_quality_counts("documents")}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  {FAILED} as base_failed, not {FAILED} and {PASSES} as kept from counts"""

QUERIES = {
    "op1_histogram_sort": (op1_histogram_sort, None),
    "op2_reply_trees": (op2_reply_trees, OP2_SQL),
    "op3_simhash_decontamination": (op3_simhash_decontamination, None),
    "op4_odd_sketch_dedup": (op4_odd_sketch_dedup, OP4_SQL),
    "op5_pii_spans": (op5_pii_spans, None),
    "op6_source_mixing": (op6_source_mixing, None),
    "op7_quality_rules": (op7_quality_rules, OP7_SQL),
    "op8_recompression_dedup": (op8_recompression_dedup, None),
    "op9_noisy_channel_toxicity": (op9_noisy_channel_toxicity, None),
    "op10_bwt_merge_dedup": (op10_bwt_merge_dedup, None),
    "op11_segment_tree_bpe": (op11_segment_tree_bpe, None),
    "op12_fragment_alignment": (op12_fragment_alignment, None),
    "op13_interval_manifest": (op13_interval_manifest, merkle.sql("documents")),
}
