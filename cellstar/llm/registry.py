"""Queries of the operators, with their SQL where SQL expresses them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.llm import (backoff_lm, bestfit, filter_audit, html_extract, kneser_ney, parity_join, phrases,
                          piece_codec, quality_rules, simple8b, suffix_dedup, toxicity, winnowing)
from cellstar.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; CELLSTAR_TOKENIZERS overrides the folder."""
    folder = os.environ.get("CELLSTAR_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of ``documents``."""
    return quality_rules.clean_lines(table(spark, sf_dir, "documents")).drop("clean_text")


ORACLES["op3_quality_rules"] = r"""
with d as (select doc_id, coalesce(text, '') as text, row_number() over () as rn from documents),
ln as (
  select rn, unnest(lines) as line, generate_subscripts(lines, 1) as k
  from (select rn, string_split(text, chr(10)) as lines from d)),
lw as (
  select rn, k, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as ws,
    row_number() over (partition by rn, line order by k) > 1 as again
  from ln),
lf as (
  select rn, k, len(ws) as nw, coalesce(list_sum([length(w) for w in ws]), 0) as wc,
    again and len(ws) > 0 as dup,
    len(ws) > 0 and (
      again
      or 100 * len(regexp_extract_all(line, '[#*$%&|<>]')) > 25 * len(ws)
      or len(regexp_extract_all(line, '[|»›•·]|::|>>')) >= 3
      or (len(ws) < 8 and not regexp_matches(line, '[.!?:;…。！？]["''”’»)\]]*[ \t\r]*$'))
      or regexp_matches(line, 'cookie|privacy policy|terms of (?:use|service)|all rights reserved|lorem ipsum|enable javascript|subscribe to our|sign up for|click here|read more\b|share this|add to cart', 'i')
    ) as failed
  from lw),
agg as (
  select rn, sum(nw) as n_words, sum(wc) as word_chars, count(*) filter (dup) as n_dup_lines, count(*) as lines,
    count(*) filter (failed) as n_failed, coalesce(sum(wc) filter (not failed), 0) as kept_chars
  from lf group by rn),
w as (
  select rn, unnest(ws) as w, generate_subscripts(ws, 1) as i
  from (select rn, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws from d)),
win as (
  select rn, i, w, lead(w, 1) over s as w2, lead(w, 2) over s as w3 from w window s as (partition by rn order by i)),
rep as (
  select rn, i, count(*) over (partition by rn, w, w2, w3) as n from win where w3 is not null),
cov as (
  select rn, count(distinct i + o) as n_repeat
  from (select rn, i, unnest([0, 1, 2]) as o from rep where n > 1) group by rn),
f as (
  select d.doc_id, d.text, agg.*, coalesce(n_repeat, 0) as n_repeat
  from d join agg using (rn) left join cov using (rn)),
b as (select *, n_words < 50 or 100 * n_repeat > 50 * n_words as base_failed from f)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
  cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
  cast(n_repeat as bigint) as n_repeat_words, base_failed,
  not base_failed and 100 * kept_chars >= 50 * word_chars as kept,
  cast(case when n_words > 0 then lines else 0 end as bigint) as n_lines, cast(n_failed as bigint) as n_failed_lines
from b
"""


@query
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of ``documents``, of their edited texts, and likenesses."""
    return winnowing.compare_neighbours(table(spark, sf_dir, "documents"))


@query
def op6_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as token ids, written and read back."""
    import public_tokenizers

    chunks = simple8b.write_ids(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                                public_tokenizers.PATTERN, 0)
    return simple8b.read_ids(chunks)


@query
def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` encoded to sentence pieces and decoded."""
    return piece_codec.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without passages of 100 bytes that start earlier too."""
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` by Jaccard similarity of four-word shingles."""
    return parity_join.similarity_components(table(spark, sf_dir, "documents"))


@query
def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of ``pages``."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return kneser_ney.identify(docs, kneser_ney.train(docs))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of ``documents``, learned from ``labels``."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op9_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` packed into bins."""
    return bestfit.pack(table(spark, sf_dir, "documents"))


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over ``documents`` in all 120 orders."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = r"""
with d as (
  select doc_id, coalesce(text, '') as text, coalesce(source, '') as part,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
marks as (
  select doc_id, max(coalesce(quality = 1, false)) as good, max(coalesce(toxic = 1, false)) as toxic
  from labels where doc_id is not null group by doc_id),
f as (
  select part, coalesce(good, false) as good, coalesce(marks.toxic, false) as toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
     100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
     doc_id is not null and coalesce(min(doc_id) over t < doc_id or bool_or(doc_id is null) over t, false)] as fails
  from d left join marks using (doc_id)
  window t as (partition by text)),
m as (
  select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from f group by part, fails),
letters as (select unnest([1, 2, 3, 4, 5]) as x),
perms as (
  select [a.x, b.x, c.x, e.x, g.x] as p
  from letters a, letters b, letters c, letters e, letters g
  where len(list_distinct([a.x, b.x, c.x, e.x, g.x])) = 5),
gone as (
  select part, p, fails, n, good, toxic,
    coalesce(list_position([fails[x] for x in p], true), 6) as gone_at
  from m, perms),
steps as (select unnest([1, 2, 3, 4, 5]) as step),
cells as (
  select part, p, step, p[step] as x, sum(n) filter (gone_at > step) as kept, sum(n) filter (gone_at = step) as removed,
    sum(n) filter (fails[p[step]] and gone_at < step) as redundant,
    sum(n) filter (fails[p[step]] and len([y for y in fails if y]) = 1) as alone,
    sum(good) filter (gone_at = step) as good_lost, sum(toxic) filter (gone_at = step) as toxic_lost
  from gone, steps group by part, p, step)
select part, array_to_string([substr('ABCDE', y, 1) for y in p], '') as filter_order,
  cast(step as integer) as step, cast(coalesce(kept, 0) as bigint) as kept,
  cast(coalesce(removed, 0) as bigint) as removed, cast(coalesce(redundant, 0) as bigint) as redundant,
  cast(coalesce(alone, 0) as bigint) as unique_fails, cast(coalesce(good_lost, 0) as bigint) as good_lost,
  cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
  cast(sum(coalesce(removed, 0)) over (partition by part, x) as bigint) as shapley
from cells
"""


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of ``documents`` by language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_collocations"] = r"""
with p as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
sizes as (select lang, sum(len(w)) as n from w group by lang),
g as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i
        from (select lang, w, unnest([1, 2, 3, 4]) as k from w))),
f as (select lang, k, phrase, count(*) as f from g group by lang, k, phrase having count(*) >= 30),
c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1),
inside as (
  select lang, array_to_string(w[i:i + size - 1], ' ') as phrase, max(a) as around
  from (select lang, a, w, size, unnest(range(1, k - size + 2)) as i
        from (select lang, k, a, w, unnest(range(2, k)) as size from c where k > 2))
  group by all),
kept as (
  select c.* from c left join inside using (lang, phrase)
  where around is null or 100 * around::hugeint < 80 * a::hugeint),
cut as (select lang, k, phrase, a, w, unnest(range(1, k)) as x from kept),
scored as (
  select cut.lang, cut.phrase, cut.a, x, h.f as l, t.f as r, (2000000 * cut.a::hugeint) // (h.f + t.f) as score
  from cut
  join f h on h.lang = cut.lang and h.phrase = array_to_string(cut.w[1:x], ' ')
  join f t on t.lang = cut.lang and t.phrase = array_to_string(cut.w[x + 1:], ' ')),
least as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, x) = 1),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from least)
select lang, rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
  cast(n as bigint) as n, cast(score as bigint) as score
from ranked join sizes using (lang) where rank <= 2000
"""


@query
def op13_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of ``documents``."""
    return backoff_lm.score(table(spark, sf_dir, "documents"))
