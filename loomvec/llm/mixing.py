"""Mixing documents to target domain weights by soft membership.

A Bernoulli naive Bayes classifier over hashed words, fitted on labelled rows, gives
each document posteriors over domains. Only words that tell a domain from the first one
by a wide and certain margin count, by their presence and by their absence, so that ever
new words and a domain's mix of languages don't crowd them out. Nonnegative rates r_i
are then fitted so that the expected domain totals T_k = sum_i r_i * tokens_i * p_ik meet
the targets: projected gradient descent on sum_k (T_k - target_k)^2 / (2 * T_k(1)) +
ridge / 2 * sum_i tokens_i * (r_i - 1)^2. A step needs K sums over all documents, which
is all the driver sees; a document's rate follows from its posteriors and the steps so far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, table_of, written

#: Domains in the order of the posteriors, with the share of the tokens that each should get.
TARGETS = {"prose": 0.92, "toxic": 0.01, "noise": 0.07}
DOMAINS = list(TARGETS)
#: log2 of the number of word buckets; pseudo-count of each.
BUCKET_BITS, SMOOTHING = 17, 0.5
#: A bucket counts for a domain where its log odds ratio to the first domain is at least so
#: many nats and so many standard errors away from 0.
RATIO_LEAST, ERRORS_LEAST = 2.0, 4.0
#: Labelled rows that the classifier is fitted on at most, those with the smallest hash.
LABELLED_MOST = 60_000
#: Gradient steps at most; the fit ends when no total is off by more than this share of all tokens.
STEPS, TOLERANCE = 40, 1e-3
#: It also ends when a step takes less than this share off the largest error (targets out of reach).
PROGRESS = 0.01
#: Steps after which the rates so far are written, so that a step needn't repeat all before it.
WRITE_EVERY = 6
#: Pull of the rates towards 1.
RIDGE = 1e-3
#: Scale of the hash that decides what a fraction of a rate becomes.
DRAW = 1 << 20
#: Marks that end words, and symbols whose runs are words of their own. Fixed values.
MARKS, SYMBOLS = '.,;:?"()', "#*$%&|<>!"
#: A word: a run of symbols, or of what is neither white space, a mark nor a symbol.
WORD = f"[{SYMBOLS}]+|[^ \\t\\n\\x0B\\f\\r{MARKS}{SYMBOLS}]+"


def domain_of(quality: Column, toxic: Column) -> Column:
    """Number of a labelled row's domain: toxic, else prose (quality 1) or noise."""
    return F.when(F.coalesce(toxic, F.lit(0)) == 1, 1).when(quality == 1, 0).otherwise(2)


def tokens_of(text: Column) -> Column:
    """Lower-case words of a text without marks, runs of symbols apart; none for null."""
    return F.regexp_extract_all(F.coalesce(F.lower(text), F.lit("")), F.lit(WORD), F.lit(0))


def buckets(words: Column, bits: int = BUCKET_BITS) -> Column:
    """Buckets of words, each once."""
    mask = F.lit((1 << bits) - 1)
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(mask).cast("int")))


def ordered(targets: dict[str, float] | None) -> list[float]:
    """Weights in the order of ``DOMAINS``; every domain must be named, and no other."""
    targets = TARGETS if targets is None else targets
    if set(targets) != set(DOMAINS) or any(not w >= 0 for w in targets.values()):
        raise ValueError(f"targets must give a weight of at least 0 for each of {', '.join(DOMAINS)}")
    return [float(targets[d]) for d in DOMAINS]


def fit_classifier(docs: DataFrame, labels: DataFrame, most: int = LABELLED_MOST, bits: int = BUCKET_BITS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row with ``model``: for every domain but the first the log odds of a document without any counted word, and what each bucket adds.

    Fitted on at most ``most`` labelled rows; labels without a key or quality don't count,
    and the highest domain wins where a key has several. A domain without labelled rows
    has posterior 0; without any label all domains are alike.
    """
    size, k = 1 << bits, len(DOMAINS)
    known = (
        labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(key).cast("long").alias("_key"))
        .agg(F.max(domain_of(F.col("quality"), F.col("toxic"))).alias("domain"))
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(most)
    )
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text")).join(F.broadcast(known), "_key")
    # a document without words has the bucket -1 alone, so that it counts as a document
    rows = rows.select("domain", F.explode(F.concat(F.array(F.lit(-1)), buckets(tokens_of(F.col("_text")), bits))).alias("bucket"))
    names = [f"n{i}" for i in range(k)]
    counts = rows.groupBy("bucket").agg(*(F.count(F.when(F.col("domain") == i, 1)).alias(n) for i, n in enumerate(names)))
    dense = docs.sparkSession.range(-1, size, 1, 4).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").na.fill(0, names)
    one = dense.agg(F.sort_array(F.collect_list(F.when(F.col("bucket") >= 0, F.struct("bucket", *names)))).alias("rows"), *(F.max(F.when(F.col("bucket") < 0, F.col(n))).alias(f"s{i}") for i, n in enumerate(names)))

    def share(r: Column, i: int) -> Column:
        return (r[f"n{i}"] + SMOOTHING) / (F.col(f"s{i}") + 2 * SMOOTHING)

    def compared(i: int) -> Column:
        """Of every bucket that counts, what its presence adds and what its absence does."""

        def of(r: Column) -> Column:
            a, b = share(r, i), share(r, 0)
            ratio, gone = F.log(a / (1 - a)) - F.log(b / (1 - b)), F.log((1 - a) / (1 - b))
            errors = F.sqrt(1 / (r[f"n{i}"] + SMOOTHING) + 1 / (r["n0"] + SMOOTHING))
            counted = (F.abs(ratio) >= RATIO_LEAST) & (F.abs(ratio) >= ERRORS_LEAST * errors)
            return F.struct(F.when(counted, ratio).otherwise(0.0).alias("adds"), F.when(counted, gone).otherwise(0.0).alias("gone"))

        return F.transform("rows", of)

    one = one.select("*", *(compared(i).alias(f"c{i}") for i in range(1, k)))
    unlabelled = sum((F.col(f"s{i}") for i in range(k)), F.lit(0)) == 0

    def model(i: int) -> Column:
        none = F.aggregate(f"c{i}", F.lit(0.0), lambda a, x: a + x["gone"])
        prior = F.when(unlabelled, 0.0).when(F.col(f"s{i}") == 0, -1000.0).when(F.col("s0") == 0, 1000.0)
        odds = prior.otherwise(F.log(F.greatest(F.col(f"s{i}"), F.lit(1)) / F.greatest(F.col("s0"), F.lit(1))) + none)
        # zeros come from the rows: a literal array of them would stand in every plan's text, megabytes long
        zeros = F.transform("rows", lambda r: F.lit(0.0).cast("float"))
        adds = F.when(unlabelled | (F.col(f"s{i}") == 0) | (F.col("s0") == 0), zeros)
        return F.struct(odds.alias("odds"), adds.otherwise(F.transform(f"c{i}", lambda x: x["adds"].cast("float"))).alias("adds"))

    return one.select(F.array(*(model(i) for i in range(1, k))).alias("model"))


def posteriors(found: Column, model: Column) -> Column:
    """Array of domain posteriors, from a document's buckets and the model."""

    def of(m: Column, i: int) -> Column:
        # the numbers are taken out of the model once, not for every bucket
        return let(m[i]["adds"], lambda adds: F.aggregate(found, m[i]["odds"], lambda a, x: a + F.get(adds, x)))

    logs = let(model, lambda m: F.array(F.lit(0.0), *(of(m, i) for i in range(len(DOMAINS) - 1))))

    def softmax(x: Column) -> Column:
        parts = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
        return let(parts, lambda e: F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, y: a + y)))

    return let(logs, softmax)


def rate_after(p: Column, steps: list[list[float]], ridge: float, most: float, start: Column) -> Column:
    """A document's rate after the given gradients (one number a domain each)."""
    if not steps:
        return start
    # numbers of the plan itself: one array of constants, made once and not for every row
    grads = F.array(*(F.struct(*(F.lit(float(x)).alias(f"g{i}") for i, x in enumerate(g))) for g in steps))

    def move(r: Column, g: Column) -> Column:
        slope = F.lit(ridge) * (r - 1)
        for i in range(len(steps[0])):
            slope = slope + p[i] * g[f"g{i}"]
        return F.greatest(F.lit(0.0), F.least(F.lit(float(most)), r - slope))

    return F.aggregate(grads, start, move)


def fit_rates(stats: DataFrame, targets: list[float], most: float, steps: int = STEPS, tolerance: float = TOLERANCE, ridge: float = RIDGE) -> tuple[list[list[float]], list[float]]:
    """Gradients of the steps made, and the totals reached, from rows of ``tokens`` and ``posteriors``.

    ``targets`` are token totals. Each step is one sum over all rows.
    """
    k, grads, errors, base = len(targets), [], [], []
    p, rate, done = F.col("posteriors"), F.lit(1.0), 0
    while True:
        # the rate is a column first, so that it is made once for all sums
        moved = stats.select("tokens", "posteriors", rate.alias("rate"))
        got = moved.agg(*(F.coalesce(F.sum(F.col("rate") * F.col("tokens") * p[i]), F.lit(0.0)).alias(f"t{i}") for i in range(k))).head()
        totals = [float(x) for x in got]
        base = base or [max(x, 1e-9) for x in totals]
        errors.append(max(abs(t - x) for t, x in zip(totals, targets, strict=True)))
        stuck = len(errors) > 1 and errors[-1] > (1 - PROGRESS) * errors[-2]
        if len(grads) >= steps or stuck or errors[-1] <= tolerance * max(sum(targets), 1e-9):
            return grads, totals
        grads.append([(t - x) / b for t, x, b in zip(totals, targets, base, strict=True)])
        if len(grads) - done > WRITE_EVERY:
            stats = written(stats.select("tokens", "posteriors", rate.alias("rate")), "rates")
            rate, done = F.col("rate"), len(grads) - 1
        start = F.col("rate") if done else F.lit(1.0)
        rate = rate_after(p, grads[done:], ridge, most, start)


def goals(held: list[float], n: float, weights: list[float], budget: float | None = None, most: float = 4.0) -> list[float]:
    """Token totals that ``mix`` aims at, from each domain's tokens and the number of all."""
    # what no document holds can't be handed out: the other domains share its weight
    weights = [w if t > 0 else 0.0 for t, w in zip(held, weights, strict=True)]
    weights = [w / (sum(weights) or 1.0) for w in weights]
    if budget is not None:
        total = budget * n
    elif most <= 1:
        total = min([t * most / w for t, w in zip(held, weights, strict=True) if w], default=0.0)
    else:
        total = n
    return [w * total for w in weights]


def totals(mixed: DataFrame, targets: dict[str, float] | None = None, budget: float | None = None, most: float = 4.0, off: float = 0.05) -> DataFrame:
    """One row a domain: tokens held, aimed at, reached by rates and reached by copies, from what ``mix`` gave for the same settings.

    ``reached`` is false for a domain whose rates are off its target by more than the share
    ``off`` of it: rates up to ``most`` may not be able to reach it.
    """
    weights = ordered(targets)
    share = lambda i, x: F.coalesce(F.sum(F.col("mix.tokens") * F.col("mix.posteriors")[i] * x), F.lit(0.0))
    factors = {"held": F.lit(1), "rates": F.col("mix.rate"), "copies": F.col("mix.copies")}
    got = mixed.agg(F.coalesce(F.sum("mix.tokens"), F.lit(0)).cast("double").alias("n"), *(share(i, x).cast("double").alias(f"{f}{i}") for i in range(len(DOMAINS)) for f, x in factors.items())).head()
    goal = goals([got[f"held{i}"] for i in range(len(DOMAINS))], got["n"], weights, budget, most)
    rows = [(d, got[f"held{i}"], goal[i], got[f"rates{i}"], got[f"copies{i}"], abs(got[f"rates{i}"] - goal[i]) <= off * goal[i]) for i, d in enumerate(DOMAINS)]
    return mixed.sparkSession.createDataFrame(rows, "domain string, held_tokens double, target_tokens double, rate_tokens double, copied_tokens double, reached boolean")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, budget: float | None = None, most: float = 4.0, text: str = "text", key: str = "doc_id", keep: list[str] | None = None, off_most: float | None = None) -> DataFrame:
    """All rows of ``docs`` (``keep``: these columns only) with a struct ``mix``: tokens (words), posteriors, rate, copies.

    ``targets`` names a weight for every domain, in any order. ``budget`` is the share of
    all words to hand out (1: as many as there are); with ``most`` <= 1 and no budget, the
    largest share at which no domain has to repeat. A domain that no document belongs to
    has no target; the others share its weight. Targets may be out of reach of rates up to
    ``most``: ``totals`` reports what was reached, and with ``off_most`` a domain that
    misses its target by more than this share of all words handed out is an error.
    ``copies`` is the rate, its fraction drawn by a hash of key and text, so that equal
    inputs give equal results. Null and empty texts have 0 tokens and the posteriors of a
    document without any counted word. Very long texts are taken whole, in one row's
    arrays. Rows stay as they are, repeated ones too; an input column named ``mix`` is
    replaced. An empty table gives no rows.
    """
    weights = ordered(targets)
    model = table_of(fit_classifier(docs, labels, text=text, key=key), "model", "classifier")
    fitted, m = free_name(docs, "_model"), free_name(docs, "_m")
    whole = F.coalesce(F.col(text), F.lit(""))
    draw = F.xxhash64(F.col(key), F.col(text)).bitwiseAND(F.lit(DRAW - 1)) / F.lit(float(DRAW))
    measured = let(tokens_of(whole), lambda w: F.struct(F.size(w).cast("long").alias("tokens"), let(buckets(w), lambda b: posteriors(b, F.col(fitted))).alias("posteriors")))
    rows = docs.withColumn(fitted, model).withColumn(m, measured).drop(fitted)
    rows = rows.withColumn("mix", F.struct(f"{m}.tokens", f"{m}.posteriors", draw.alias("draw"))).drop(m)
    if keep is not None:
        rows = rows.select(*keep, "mix")
    rows = written(rows, "mixing")
    stats = rows.select("mix.tokens", "mix.posteriors")
    k = len(DOMAINS)
    all_tokens = stats.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("double").alias("n"), *(F.coalesce(F.sum(F.col("tokens") * F.col("posteriors")[i]), F.lit(0.0)).alias(f"t{i}") for i in range(k))).head()
    goal = goals([all_tokens[f"t{i}"] for i in range(k)], all_tokens["n"], weights, budget, most)
    grads, reached = fit_rates(stats, goal, most)
    if off_most is not None and any(abs(t - g) > off_most * sum(goal) for t, g in zip(reached, goal, strict=True)):
        raise ValueError("targets out of reach: " + ", ".join(f"{d} {t:.0f} of {g:.0f}" for d, t, g in zip(DOMAINS, reached, goal, strict=True)))
    r = free_name(rows, "_rate")
    out = rows.withColumn(r, rate_after(F.col("mix.posteriors"), grads, RIDGE, most, F.lit(1.0)))
    whole_part = F.floor(r)
    copies = whole_part + F.when(F.col("mix.draw") < F.col(r) - whole_part, 1).otherwise(0)
    return out.withColumn("mix", F.struct("mix.tokens", "mix.posteriors", F.col(r).alias("rate"), copies.cast("long").alias("copies"))).drop(r)
