"""Quality rules with risk-controlled cutoffs.

Every text gets a few counts. A rule rejects a document whose measure (a ratio of counts) reaches the cutoff of the
document's stratum (its language). Cutoffs come from labelled holdouts: going from the loosest cutoff of a grid to
the tightest, a cutoff is allowed while the exact binomial test still shows, at level ``delta`` divided by the
number of strata and rules, that less than ``alpha / number of rules`` of the stratum's good documents reach it; the
first one that fails ends the walk (fixed-sequence testing), and the last allowed one holds. So with probability
1 - ``delta`` no stratum loses more than ``alpha`` of its good documents. A stratum with too few labels to show
that has no cutoff, and its documents are judged by the base rule alone. Cutoffs are a table with a row per stratum, made
in tasks and joined to the documents, so there may be any number of strata.

Edge cases: null text counts as empty (all counts 0, base_failed); null language is a stratum of its own; null labels
and documents with contradicting labels teach nothing; repeated documents are counted each; tables may be empty;
other columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm import store
from demandspark.llm.text import Words, mix, runs_sum, slices

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50

#: rule: (numerator, denominator, cutoffs from loose to tight)
RULES = {
    "symbols": ("n_symbols", "n_words", (4.0, 3.0, 2.5, 2.0, 1.5, 1.0, 0.8, 0.5, 0.3, 0.2, 0.1)),
    "upper": ("n_upper", "word_chars", (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25)),
    "repeats": ("n_repeat_words", "n_words", (0.5, 0.45, 0.4, 0.35, 0.3, 0.25)),
    "dup_lines": ("n_dup_lines", "n_lines", (0.95, 0.9, 0.8, 0.7, 0.6, 0.5)),
}


def repeated_words(w: Words) -> np.ndarray:
    """Per text: words covered by a window of three words that occurs twice or more in the text."""
    first = w.windows(3)
    if not len(first):
        return np.zeros(len(w.count), dtype=np.int64)
    h, owner = w.hashes(), w.text_of().astype(np.uint64)
    key = mix(h[first] + mix(h[first + 1] + mix(h[first + 2] + mix(owner[first] + np.uint64(1)))))
    _, where, n = np.unique(key, return_inverse=True, return_counts=True)
    again = first[n[where] > 1]
    covered = np.zeros(len(h), dtype=np.int64)
    for k in range(3):
        covered[again + k] = 1
    return runs_sum(covered, w.first)


def lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    real = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(real), len(real) - len(set(real))


def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    is_symbol = np.isin(np.arange(256), list(SYMBOLS))
    for b in batches:
        for s in slices(b):
            w = Words(s.column("text"))
            per_text = lambda mask: runs_sum(mask, w.offsets)  # noqa: E731, B023
            n_lines, dup = zip(*map(lines, s.column("text").to_pylist()), strict=True)
            counts = {
                "n_words": w.count,
                "word_chars": per_text(~w.space & ((w.data & 0xC0) != 0x80)),
                "n_symbols": per_text(is_symbol[w.data]),
                "n_dup_lines": np.array(dup),
                "n_repeat_words": repeated_words(w),
                "n_upper": per_text((w.data >= 65) & (w.data <= 90)),
                "n_lines": np.array(n_lines),
            }
            yield pa.record_batch([s.column("doc_id"), s.column("lang"), *(pa.array(counts[c], pa.int64()) for c in COUNTS)], ["doc_id", "lang", *COUNTS])


def measure(docs: DataFrame) -> DataFrame:
    """Counts of every whole text; (doc_id, lang, COUNTS)."""
    lang = "lang" if "lang" in docs.columns else F.lit(None).cast("string").alias("lang")
    return docs.select("doc_id", "text", lang).mapInArrow(count, "doc_id long, lang string, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def ratio(rule: str):
    up, down, _ = RULES[rule]
    return F.when(F.col(down) > 0, F.col(up) / F.col(down)).otherwise(0.0)


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial, by its exact terms."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    return min(1.0, math.fsum(map(math.exp, logs)))


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """(lang, cut_<rule>): a row per stratum with its cutoffs, null where a rule has none; a written table."""
    good = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("lo")).where("lo = 1").select("doc_id")
    held = measured.where(~base_failed()).join(good, "doc_id")
    reach = [F.sum((ratio(r) >= c).cast("long")).alias(f"{r}_{k}") for r, (_, _, grid) in RULES.items() for k, c in enumerate(grid)]
    strata = store.keep(held.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *reach), "rule-strata")
    level, share = delta / max(1, strata.count() * len(RULES)), alpha / len(RULES)

    def walk(hits: list[int], n: int, grid: tuple[float, ...]) -> float | None:
        cut = None
        for k, c in zip(hits, grid, strict=True):
            if k > share * n or at_most(k, n, share) > level:
                break
            cut = c
        return cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column("n").to_pylist()
            cuts = []
            for r, (_, _, grid) in RULES.items():
                hits = zip(*(b.column(f"{r}_{k}").to_pylist() for k in range(len(grid))), strict=True)
                cuts.append(pa.array([walk(h, m, grid) for h, m in zip(hits, n, strict=True)], pa.float64()))
            yield pa.record_batch([b.column("lang"), *cuts], ["lang", *(f"cut_{r}" for r in RULES)])

    return store.keep(strata.mapInArrow(run, "lang string, " + ", ".join(f"cut_{r} double" for r in RULES)), "rule-cuts")


def judge(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Counts, base_failed and the verdict ``kept`` of every document."""
    measured = store.keep(measure(docs), "rule-counts")
    cuts = cutoffs(measured, labels, alpha, delta).withColumnRenamed("lang", "stratum")
    reject = F.lit(False)
    for r in RULES:
        reject = reject | F.coalesce(ratio(r) >= F.col(f"cut_{r}"), F.lit(False))
    # few strata are broadcast by the optimizer's own check of the written table's size
    known = measured.join(cuts, F.col("lang").eqNullSafe(F.col("stratum")), "left")
    return known.select(*(c for c in measured.columns if c != "lang"), base_failed().alias("base_failed"), (~base_failed() & ~reject).alias("kept"))


def oracle(alpha: float = 0.02, delta: float = 0.05) -> str:
    """The same in DuckDB SQL."""
    hit = ", ".join(f"sum(({up} >= {c} * {down} and {down} > 0)::bigint)::bigint as {r}_{k}" for r, (up, down, grid) in RULES.items() for k, c in enumerate(grid))
    long = " union all ".join(f"select lang, n, '{r}' as rule, {k} as step, {c}::double as cut, {r}_{k} as hits from strata" for r, (_, _, grid) in RULES.items() for k, c in enumerate(grid))
    value = "case rule " + " ".join(f"when '{r}' then case when {down} > 0 then {up}::double / {down} else 0 end" for r, (up, down, _) in RULES.items()) + " end"
    return f"""
with docs as (select doc_id, lang, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents),
tri as (select doc_id, i, ws[i] || chr(32) || ws[i + 1] || chr(32) || ws[i + 2] as t from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from docs)),
rep as (select doc_id, count(distinct i + k) as n from (select doc_id, i from tri qualify count(*) over (partition by doc_id, t) > 1), range(3) as r(k) group by doc_id),
ln as (select doc_id, line from (select doc_id, unnest(string_split(text, chr(10))) as line from docs) where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
ln2 as (select doc_id, count(*) as n_lines, count(*) - count(distinct line) as dup from ln group by doc_id),
counts as (select doc_id, lang, len(ws)::bigint as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(dup, 0)::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words,
  length(regexp_replace(text, '[^A-Z]', '', 'g'))::bigint as n_upper, coalesce(n_lines, 0)::bigint as n_lines
  from docs left join rep using (doc_id) left join ln2 using (doc_id)),
base as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed from counts),
good as (select doc_id from labels where quality is not null group by doc_id having min(quality) = 1),
strata as (select lang, count(*)::bigint as n, {hit} from base join good using (doc_id) where not base_failed group by lang),
tests as ({long}),
parts as (select *, unnest(range(0, case when hits > {alpha / len(RULES)} * n then 1 else hits + 1 end)) as i from tests),
terms as (select lang, rule, step, cut, n, hits, sum(exp(case when n = 0 then 0 else lgamma(n + 1) end - case when i = 0 then 0 else lgamma(i + 1) end - case when i >= n then 0 else lgamma(n - i + 1) end + i * ln({alpha / len(RULES)}) + (n - i) * ln(1 - {alpha / len(RULES)}))) as p
  from parts group by all),
walk as (select *, max(case when hits > {alpha / len(RULES)} * n or p > {delta} / ((select count(*) from strata) * {len(RULES)}) then 1 else 0 end) over (partition by lang, rule order by step) as ended from terms),
cuts as (select lang, rule, min(cut) as cut from walk where ended = 0 group by lang, rule),
bad as (select distinct b.doc_id from base b join cuts c on b.lang is not distinct from c.lang where {value} >= cut)
select base.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_lines, base_failed, not base_failed and bad.doc_id is null as kept
from base left join bad using (doc_id)"""
