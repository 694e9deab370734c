"""URL filter: longest-prefix rules first, a character language-model ratio for the rest.

Two variable-order Markov models over characters are trained on the URLs that
the rules accept and reject. At each position the longest context that
training has seen decides; every order is smoothed towards the next lower one.
A URL's score is the mean over its characters of ``log P(accepted) - log
P(rejected)``, and the threshold is calibrated on a held-out fold of the ruled
URLs (largest gap between the two acceptance rates).

The sum over positions telescopes: with ``delta(g) = ratio(g) - ratio(g[1:])``
the ratio of the longest seen gram is the sum of ``delta`` over all seen grams
that end there, because a gram can only be seen if its suffixes are. So a
URL's total is one sum over its grams, which combines before any shuffle.

Everything is built-in Spark. Gram statistics cover every ruled URL and are
kept by the gram itself, so a gram that training has not seen gives 0. The
model grows with the ruled URLs and is joined by a shuffle, never broadcast:
first to the distinct tails of the URLs (a character with all its context),
then tails to URLs, one row per URL and tail.

Cases: a null URL or one without ``://`` has an empty host and path, no rule
and score 0; so has a URL with empty host and path. Repeated rows are judged
row by row. With no accepted or no rejected URL to learn from every score is 0
and the threshold 0, so the verdict is ``allow``. Extra input columns are not
read. A rule fits its host and all subdomains; the longest fitting rule wins,
and among equally long ones a blocking one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import ascii_lower, staged

ORDER = 4              # longest context, in characters
PRIOR = 0.5            # weight of the next lower order against observed counts
ALPHABET = 256.0       # order -1: uniform over this many characters
HELD_OUT_FOLDS = 5     # one fold of the ruled URLs calibrates, the others train
SCORE_BINS = 2000      # calibration histogram over scores in [-SCORE_SPAN, SCORE_SPAN]
SCORE_SPAN = 10.0
START = "\u0002"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://``, lower-cased A-Z; path up to ``?`` or ``#``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return ascii_lower(part(1)), part(2)


def _fits(rule: str, host: Column, path: Column) -> Column:
    rule_host, slash, rest = rule.partition("/")
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)


def rule_of(host: Column, path: Column, allow: Sequence[str], block: Sequence[str]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, nulls where none fits."""
    verdicts = {**{r: "allow" for r in allow}, **{r: "block" for r in block}}
    rule = verdict = F.lit(None).cast("string")
    for text in sorted(verdicts, key=lambda r: (len(r), verdicts[r] == "block", r)):
        fits = _fits(text, host, path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(verdicts[text])).otherwise(verdict)
    return rule, verdict


def _grams(frame: DataFrame, text: str) -> DataFrame:
    """One row per position and order: ``gram`` is the character with its context before it."""
    end = F.explode_outer(F.expr(f"if(length({text}) < 2, null, sequence(2, length({text})))"))
    return (frame.withColumn("_end", end)
            .withColumn("_len", F.explode_outer(F.expr(f"if(_end is null, null, sequence(1, least({ORDER + 1}, _end)))")))
            .withColumn("gram", F.expr(f"substring({text}, _end - _len + 1, _len)")))


def train(ruled: DataFrame) -> DataFrame:
    """Model rows (gram, delta), one per gram seen, from rows (marked, accepted)."""
    counts = (_grams(ruled, "marked").where("gram is not null").groupBy("gram")
              .agg(F.sum(F.col("accepted").cast("long")).alias("a"),
                   F.sum((~F.col("accepted")).cast("long")).alias("r")))
    counts = staged(counts.withColumn("len", F.length("gram")), "url-grams")
    context = (counts.groupBy(F.expr("substring(gram, 1, len - 1)").alias("context"))
               .agg(F.sum("a").alias("context_a"), F.sum("r").alias("context_r")))
    # Each gram with its suffixes: at most ORDER + 1 rows, shortest first, carry all it needs.
    seen = (counts.join(context, F.expr("substring(gram, 1, len - 1)") == F.col("context"))
            .select(F.col("gram").alias("suffix"), "a", "r", "context_a", "context_r"))
    links = (counts.select("gram", F.explode(F.expr("sequence(1, len)")).alias("k"))
             .withColumn("suffix", F.expr("right(gram, k)")))
    chain = (links.join(seen, "suffix").groupBy("gram")
             .agg(F.array_sort(F.collect_list(F.struct("k", "a", "r", "context_a", "context_r"))).alias("orders"),
                  F.max(F.struct("k", "a", "r")).alias("own")))
    step = f"""aggregate(orders,
        named_struct('pa', {1 / ALPHABET}D, 'pr', {1 / ALPHABET}D, 'last', 0D),
        (s, o) -> named_struct(
            'pa', (o.a + {PRIOR}D * s.pa) / (o.context_a + {PRIOR}D),
            'pr', (o.r + {PRIOR}D * s.pr) / (o.context_r + {PRIOR}D),
            'last', ln(s.pa / s.pr)))"""
    return (chain.withColumn("p", F.expr(step))
            .select("gram", (F.log(F.col("p.pa") / F.col("p.pr")) - F.col("p.last")).alias("delta")))


def _tails(rows: DataFrame) -> DataFrame:
    """(_row, tail, n): each character with its whole context, counted per URL."""
    end = F.explode(F.expr("if(length(marked) < 2, null, sequence(2, length(marked)))"))
    tail = F.expr(f"substring(marked, greatest(1, _end - {ORDER}), least({ORDER + 1}, _end))")
    return rows.select("_row", "marked", end.alias("_end")).groupBy("_row", tail.alias("tail")).agg(F.count(F.lit(1)).alias("n"))


def score(urls: DataFrame, model: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and ``score`` for each row of ``urls`` with column ``marked``."""
    columns = list(dict.fromkeys(["marked", *keep]))
    rows = staged(urls.select(F.monotonically_increasing_id().alias("_row"), *columns), "url-rows")
    tails = _tails(rows)
    # A tail's ratio is the sum of delta over its seen suffixes.
    grams = (tails.select("tail").distinct().withColumn("_len", F.explode(F.expr("sequence(1, length(tail))")))
             .select("tail", F.expr("right(tail, _len)").alias("gram")))
    # The merge hints keep every size on the shuffle join, which AQE splits at hot tails.
    ratios = grams.join(model.hint("merge"), "gram").groupBy("tail").agg(F.sum("delta").alias("ratio"))
    totals = (tails.join(ratios.hint("merge"), "tail").groupBy("_row")
              .agg(F.sum(F.col("ratio") * F.col("n")).alias("_total")))
    length = F.greatest(F.length("marked") - 1, F.lit(1))
    scores = (F.coalesce("_total", F.lit(0.0)) / F.coalesce(length, F.lit(1))).alias("score")
    return rows.join(totals.hint("merge"), "_row", "left").select(*keep, scores)


def threshold(scored: DataFrame) -> float:
    """Score at which accepted and rejected rows (``accepted`` boolean) are best told apart."""
    width = 2 * SCORE_SPAN / SCORE_BINS
    level = F.floor((F.greatest(F.least("score", F.lit(SCORE_SPAN)), F.lit(-SCORE_SPAN)) + SCORE_SPAN) / width)
    bins = (scored.groupBy(level.alias("level"))
            .agg(F.sum(F.col("accepted").cast("long")).alias("a"), F.sum((~F.col("accepted")).cast("long")).alias("r"))
            .orderBy("level").limit(SCORE_BINS + 1).collect())  # a histogram: SCORE_BINS + 1 rows at most
    accepted, rejected = sum(b.a for b in bins), sum(b.r for b in bins)
    if not accepted or not rejected:
        return 0.0
    below_a = below_r = 0
    edges = []
    for b in bins:
        gap = below_r / rejected - below_a / accepted
        edges.append((gap, b.level * width - SCORE_SPAN))
        below_a, below_r = below_a + b.a, below_r + b.r
    best = max(gap for gap, _ in edges)
    ties = [at for gap, at in edges if gap >= best]
    return ties[len(ties) // 2]


def judge_urls(pages: DataFrame, allow: Sequence[str], block: Sequence[str],
               id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict (allow or block) and the score."""
    url = F.col(url_column)
    host, path = split_url(url)
    rows = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), allow, block)
    rows = rows.select("*", rule.alias("rule"), ruled.alias("ruled"), F.concat("host", "path").alias("_address"))
    rows = rows.withColumn("marked", F.when(F.col("_address") == "", "").otherwise(F.concat(F.lit(START), "_address")))
    # One URL is one piece of evidence, however many rows repeat it.
    evidence = rows.where("ruled is not null and _address <> ''").select("marked", (F.col("ruled") == "allow").alias("accepted")).distinct()
    fold = F.pmod(F.xxhash64("marked"), F.lit(HELD_OUT_FOLDS))
    model = staged(train(evidence.where(fold != 0)), "url-model")
    scored = staged(score(rows, model, [id_column, "host", "path", "rule", "ruled", "marked"]), "url-scores")
    held_out = scored.where(F.col("ruled").isNotNull() & (F.col("marked") != "")).where(fold == 0)
    level = threshold(held_out.select("marked", "score", (F.col("ruled") == "allow").alias("accepted")).distinct())
    verdict = F.coalesce("ruled", F.when(F.col("score") >= level, "allow").otherwise("block"))
    return scored.select(id_column, "host", "path", "rule", verdict.alias("verdict"), "score")
