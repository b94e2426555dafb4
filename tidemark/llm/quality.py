"""Quality rules with host verdicts, in native DataFrame functions only.

Each document is measured by word, symbol, line and repetition counts of its whole text. Rule failures are
aggregated by host (the ``source`` column); a host's failure rate is shrunk towards the corpus with a beta prior
fitted to the hosts' rates by moments, and the host's verdict is joined back to its documents:

* ``base_failed``: fewer than 10 words, or more than 20 % of the words in repeated five-word windows;
* ``rule_failed``: more than ``SYMBOLS`` symbols a word, more than ``DUP_LINES`` of the lines repeated, or a mean word
  length over ``WORD_CHARS``;
* a host is *suspect* if its shrunk failure rate exceeds ``HOST_RATE``: its documents must then meet half of each of
  those limits and of the base limit on repetition. A clean document of a suspect host is therefore kept.

Defined results: null or blank text has no words, so it fails the base rules; a null host is a host of its own; every
row is judged (repeated rows too), a null ``doc_id`` stays null; extra columns are ignored; an empty table gives no
rows. Very long texts are measured whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, materialize

SYMBOLS, DUP_LINES, WORD_CHARS, HOST_RATE = 0.1, 0.5, 15.0, 0.5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: Column) -> Column:
    """Words covered by five-word windows that occur twice or more.

    Windows are compared by 64-bit hash; positions of repeated windows come from one sort of (hash, position), and
    the covered words are the union of the [p, p+4] ranges. Documents without a repeated window skip the sort.
    """
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(5)]))
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

    def repeated(s: Column) -> Column:
        """Positions whose hash equals that of a neighbour in sorted order, ascending."""
        same = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, i: F.least(F.lit(5), F.coalesce(F.get(p, i + 1) - x, F.lit(5))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x).cast("long")

    # ``let`` bindings: a one-element array makes each intermediate evaluated once per row
    let = lambda col, fn: F.get(F.transform(F.array(col), fn), F.lit(0))
    some = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    found = let(pairs, lambda s: let(repeated(s), covered))
    return F.when(n < 6, F.lit(0).cast("long")).when(some, found).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, text: str = "text") -> dict[str, Column]:
    """Measure columns over ``text``; they refer to ``_text``, ``_words`` and ``_lines`` of :func:`measured`."""
    t, w = F.col("_text"), F.col("_words")
    plain = t
    for ch in "#*$%&|<>":
        plain = F.replace(plain, F.lit(ch), F.lit(""))
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(plain)).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": _repeat_words(w),
    }


def measured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` plus the measures of each row's whole text."""
    space = F.lit(ASCII_SPACE)
    t = F.coalesce(F.col(text), F.lit(""))
    raw = docs.select(*[F.col(c) for c in keep], t.alias("_text"))
    words = F.array_remove(F.split("_text", "[\\x20\\x09-\\x0D]+"), "")
    lines = F.filter(F.split("_text", "\n"), lambda x: F.ltrim(x, space) != "")
    cut = raw.withColumn("_words", words).withColumn("_lines", lines)
    return cut.select(*keep, *[c.alias(n) for n, c in measure(cut).items()])


def _rules(limit: float) -> Column:
    """True if a document fails a rule with all limits multiplied by ``limit``."""
    n = F.col("n_words")
    return ((F.col("n_symbols") > F.lit(SYMBOLS * limit) * n)
            | (F.col("n_dup_lines") > F.lit(DUP_LINES * limit) * F.col("n_lines"))
            | (F.col("word_chars") > F.lit(WORD_CHARS) * n))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(alpha, beta) of a beta prior matched to the mean and variance of the hosts' failure rates (one row, two
    numbers on the driver). With fewer than two hosts, or hosts without spread, the prior is weak: weight 2."""
    r = hosts.agg(F.sum("failed").alias("f"), F.sum("docs").alias("n"), F.count("*").alias("k"),
                  F.var_pop(F.col("failed") / F.col("docs")).alias("v")).first()
    if not r["n"]:
        return 1.0, 1.0
    mean = min(max(r["f"] / r["n"], 1e-6), 1 - 1e-6)
    var = r["v"] or 0.0
    weight = mean * (1 - mean) / var - 1 if r["k"] > 1 and var > 0 else 2.0
    weight = min(max(weight, 2.0), 1e6)
    return mean * weight, (1 - mean) * weight


def quality(docs: DataFrame, keep: list[str] | None = None, text: str = "text", host: str = "source",
            only_kept: bool = False) -> DataFrame:
    """``keep`` (default ``doc_id``) with the measures, ``base_failed``, ``rule_failed``, ``host_rate`` and ``kept``;
    with ``only_kept`` just the ``keep`` columns of the rows that are kept."""
    keep = ["doc_id"] if keep is None else keep
    has_host = F.col(host) if host in docs.columns else F.lit(None).cast("string")
    named = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_raw"),
                        has_host.alias("_host"))
    ids = [f"_k{i}" for i in range(len(keep))]
    n, rep = F.col("n_words"), F.col("n_repeat_words")
    rows = materialize(measured(named, [*ids, "_host"], "_raw")
                       .withColumn("base_failed", (n < 10) | (100 * rep > 20 * n))
                       .withColumn("rule_failed", _rules(1.0)), compression="zstd")
    hosts = rows.groupBy("_host").agg(F.count("*").alias("docs"),
                                      F.sum((F.col("base_failed") | F.col("rule_failed")).cast("long")).alias("failed"))
    a, b = beta_prior(hosts)
    verdict = hosts.select(F.col("_host").alias("_h"),
                           ((F.col("failed") + F.lit(a)) / (F.col("docs") + F.lit(a + b))).alias("host_rate"))
    strict = _rules(0.5) | (100 * rep > 10 * n)
    named = [F.col(i).alias(c) for i, c in zip(ids, keep)]
    judged = (rows.join(verdict, F.col("_host").eqNullSafe(F.col("_h")), "left")
            .withColumn("kept", ~F.col("base_failed") & ~F.col("rule_failed")
                        & ~((F.col("host_rate") > HOST_RATE) & strict)))
    if only_kept:
        return judged.where("kept").select(*named)
    return judged.select(*named, *MEASURES, "base_failed", "kept", "n_lines", "rule_failed", "host_rate")


def op9(docs: DataFrame) -> DataFrame:
    return quality(docs).select("doc_id", *MEASURES, "base_failed", "kept", "n_lines", "rule_failed", "host_rate")


SQL = r"""
with t as (select doc_id, source, coalesce(text, '') as text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l, row_number() over () as rid from documents),
win as (select rid, i, w[i:i+4] as g from (select rid, w, unnest(range(1, len(w) - 3)) as i from t where len(w) >= 5)),
dup as (select rid, i from (select rid, i, count(*) over (partition by rid, g) as c from win) where c > 1),
rep as (select rid, sum(least(5, coalesce(nx - i, 5)))::bigint as r from
        (select rid, i, lead(i) over (partition by rid order by i) as nx from dup) group by rid),
m as (select t.rid, doc_id, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(l)::bigint as n_lines,
             (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(r, 0)::bigint as n_repeat_words
      from t left join rep on t.rid = rep.rid),
f as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
             n_symbols > 0.1::double * n_words or n_dup_lines > 0.5::double * n_lines
             or word_chars > 15.0::double * n_words as rule_failed from m),
h as (select source, count(*) as docs, sum((base_failed or rule_failed)::bigint) as failed from f group by source),
p as (select least(greatest(sum(failed) / sum(docs), 1e-6::double), 1 - 1e-6::double) as mean,
             var_pop(failed / docs) as v, count(*) as k from h),
q as (select mean, least(greatest(case when k > 1 and v > 0 then mean * (1 - mean) / v - 1 else 2.0::double end,
                                  2.0::double), 1e6::double) as weight from p),
r as (select source, (failed + mean * weight) / (docs + (mean * weight + (1 - mean) * weight)) as host_rate from h, q)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not rule_failed and not (host_rate > 0.5 and (n_symbols > 0.05::double * n_words
         or n_dup_lines > 0.25::double * n_lines or word_chars > 15.0::double * n_words
         or 100 * n_repeat_words > 10 * n_words)) as kept, n_lines, rule_failed, host_rate
from f join r on f.source is not distinct from r.source
"""
