"""URL filter: a character language-model ratio beside host and path rules,
in DataFrame expressions only.

URLs that a rule allows or blocks are the labelled text.  Two variable-order
Markov models over characters (one per verdict) are counted over *all* labelled
URLs outside a held-out part (3/16), smoothed from order 0 to ``order`` by
Witten-Bell interpolation:

    P_k(c | ctx) = (n(ctx c) + T(ctx) P_{k-1}(c | shorter ctx)) / (N(ctx) + T(ctx))

with N the occurrences of the context and T its distinct successors (an unseen
context leaves P_{k-1} as it is; below order 0 stands 1 / ``alphabet``).  A URL
scores the mean over its characters of log P_allow - log P_block, and is
accepted from a threshold calibrated on the held-out labelled URLs: the point
between the two verdicts' mean scores that is equally many standard deviations
from both.

Only the longest n-grams are counted from the URLs; shorter ones are rolled up
from those counts.  Each distinct URL is scored once, so a hot URL or host costs
nothing extra, and every n-gram's log ratio is computed once and joined to the
positions (both sides shuffled by n-gram, which AQE may split; nothing but the
one row of calibration figures reaches the driver).

Defined results: a null URL or one without ``://`` has empty host and path, no
rule and the verdict ``block`` (there is nothing to fetch); repeated rows get
equal results; with labels of one verdict only, the method gives that verdict;
without any, ``allow``.  Input columns are kept, those called like an output
column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardwise.llm.common import materialise

ORDER = 4  # characters of context
ALPHABET = 256
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host/path-prefix, such as "net/es/"

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1] if "/" in self.text else ""


#: fixed values of the contract
RULES = (Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"), Rule("block", "net/es/"), Rule("block", "net/fr/"))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"\A([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"\A[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (text, verdict) of the longest fitting rule, else null."""
    out = F.lit(None)
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict == "block")):  # later ones win
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def held_out(url: Column) -> Column:
    """Three sixteenths of the URLs, chosen by their hash, are not counted."""
    return F.substring(F.md5(url), 1, 1).isin("0", "1", "2")


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """One row per character of each URL (and its end): the character with
    ``order`` characters before it."""
    padded = F.concat(F.lit(START * order), _rest(F.col("url")), F.lit(END))
    lowered = F.translate(padded, UPPER, LOWER)
    return urls.withColumn("_s", lowered).select("*", F.explode(F.transform(F.sequence(F.lit(1), F.length("_s") - order), lambda i: F.substr("_s", i, F.lit(order + 1)))).alias("gram")).drop("_s")


def _smoothed(grams: DataFrame, order: int, alphabet: int) -> DataFrame:
    """gram -> log P_allow - log P_block for every gram in ``grams`` (columns
    gram, a, b: occurrences under each verdict)."""
    prob = None
    for k in range(order + 1):
        counts = grams.groupBy(F.right("gram", F.lit(k + 1)).alias("g")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        context = F.left("g", F.lit(k))
        totals = counts.groupBy(context.alias("ctx")).agg(
            F.sum("a").alias("Na"), F.sum("b").alias("Nb"), F.count_if(F.col("a") > 0).alias("Ta"), F.count_if(F.col("b") > 0).alias("Tb"))
        rows = counts.withColumn("ctx", context).join(totals, "ctx")
        if prob is None:
            rows = rows.withColumn("Pa", F.lit(1.0 / alphabet)).withColumn("Pb", F.lit(1.0 / alphabet))
        else:
            rows = rows.withColumn("_lower", F.right("g", F.lit(k))).join(prob, "_lower")
        mixed = [F.when(F.col("N" + x) == 0, F.col("P" + x)).otherwise((F.col(x) + F.col("T" + x) * F.col("P" + x)) / (F.col("N" + x) + F.col("T" + x))).alias("P" + x) for x in "ab"]
        prob = rows.select(F.col("g").alias("_lower"), *mixed)
    return prob.select(F.col("_lower").alias("gram"), (F.log("Pa") - F.log("Pb")).alias("llr"))


def threshold(stats: dict[str, tuple[float, float]]) -> float | None:
    """Between the verdicts' mean scores, equally many deviations from both.
    With one verdict only, a bound that always gives it."""
    if not stats:
        return float("-inf")
    if len(stats) == 1:
        return float("-inf") if "allow" in stats else float("inf")
    (ma, sa), (mb, sb) = stats["allow"], stats["block"]
    return (ma + mb) / 2 if sa + sb == 0 else (ma * sb + mb * sa) / (sa + sb)


def judge(df: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES, order: int = ORDER, alphabet: int = ALPHABET) -> DataFrame:
    """``df`` with host, path, rule, verdict and lm_score."""
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    known = df.select(F.col(url).cast("string").alias("url")).where("url is not null").distinct()
    known = known.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url"))).withColumn("fit", fit)
    known = materialise(known.select("url", "host", "path", F.col("fit.text").alias("rule"), F.col("fit.verdict").alias("given"),
                                     held_out(F.col("url")).alias("held"), F.monotonically_increasing_id().alias("uid")), "url-rules")
    cut = _grams(known.where(F.instr("url", "://") > 0).select("uid", "url", "given", "held"), order).select("uid", "gram", "given", "held")
    learnt = lambda v: F.count_if((F.col("given") == v) & ~F.col("held"))
    grams = materialise(cut.groupBy("gram").agg(learnt("allow").alias("a"), learnt("block").alias("b")), "url-grams")
    ratio = _smoothed(grams, order, alphabet)
    scores = cut.select("uid", "gram").join(ratio, "gram").groupBy("uid").agg(F.avg("llr").alias("lm_score"))
    scored = materialise(known.join(scores, "uid", "left").drop("uid"), "url-scores")
    held = F.when(F.col("held"), F.col("lm_score"))
    labelled = scored.where("given is not null and lm_score is not null").groupBy("given").agg(
        F.avg(held).alias("hm"), F.stddev_pop(held).alias("hs"), F.count(held).alias("n"), F.avg("lm_score").alias("m"), F.stddev_pop("lm_score").alias("s"))
    rows = labelled.collect()  # a row per verdict
    # a verdict of few URLs may have none held out: then all labelled ones calibrate
    apart = all(r["n"] for r in rows)
    bar = threshold({r["given"]: (r["hm"], r["hs"]) if apart else (r["m"], r["s"]) for r in rows})
    chosen = F.when(F.col("lm_score") >= F.lit(bar), "allow").otherwise("block")
    verdicts = scored.select(F.col("url").alias("__judged_url"), "host", "path", "rule", F.coalesce("given", chosen).alias("verdict"), "lm_score")
    kept = df.drop(*[c for c in ("host", "path", "rule", "verdict", "lm_score") if c != url])
    out = kept.join(verdicts, F.col(url).cast("string") == F.col("__judged_url"), "left")
    empty = {c: F.coalesce(F.col(c), F.lit("")) for c in ("host", "path")}
    return out.withColumns({**empty, "verdict": F.coalesce("verdict", F.lit("block"))}).drop("__judged_url")
