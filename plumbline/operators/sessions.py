"""Scores, trends and rollups along conversations.

The evidence of an assistant turn is everything said before it in the same
conversation. Turns are never paired with each other: a token is grounded when
its first occurrence in the conversation (one minimum per conversation and term)
lies before the turn, and that occurrence is the unit the token is owed to.
Ordered steps use :mod:`plumbline.functions.scan`, so one conversation may hold
any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import scan
from plumbline.functions import text as T
from plumbline.functions.clock import epoch_micros
from plumbline.functions.text import r6
from plumbline.operators.decide import band_of, runtime_decision
from plumbline.sources.interactions import pair_turns
from plumbline.session import materialise

AMBER_AT = 0.2
GREEN_AT = 0.35
ALPHA = 0.3


def turn_terms(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, term, n, origin, g``: terms of each turn, the first turn
    of the conversation that used them, and whether that lies before this one."""
    terms = (
        T.exploded(turns, ["conv_id", "turn", "role"], T.tokens(F.col("text")), "term")
        .groupBy("conv_id", "turn", "role", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    origin = terms.groupBy("conv_id", "term").agg(F.min("turn").alias("origin"))
    return terms.join(origin, ["conv_id", "term"]).withColumn(
        "g", (F.col("origin") < F.col("turn")).cast("bigint")
    )


def _share(n: Column, hit: Column) -> Column:
    return r6(F.sum(n * hit) / F.sum(n))


def turn_scores(turns: DataFrame, amber_at: float = AMBER_AT, green_at: float = GREEN_AT) -> DataFrame:
    """``conv_id, turn, n_tokens, reverse_context, band`` of every assistant turn."""
    placed = scan.prefix(
        turns.select("conv_id", "turn", "role"),
        ["conv_id"],
        F.col("turn"),
        {"n_units": ("count", F.lit(1))},
    ).filter(F.col("role") == "assistant")
    scored = (
        turn_terms(turns)
        .filter(F.col("role") == "assistant")
        .groupBy("conv_id", "turn")
        .agg(F.sum("n").alias("n_tokens"), _share(F.col("n"), F.col("g")).alias("reverse_context"))
    )
    return placed.join(scored, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
        "reverse_context",
        F.when(F.col("n_units") == 0, "unsupported")
        .otherwise(band_of(F.col("reverse_context"), amber_at, green_at))
        .alias("band"),
    )


def query_scores(turns: DataFrame) -> DataFrame:
    """Per response: ``reverse_context``, ``reverse_query_context`` (the query's tokens
    in what preceded it), ``echo_mean`` (the response's tokens in its query) and
    ``triangular``, their geometric mean (0 as soon as one is 0)."""
    pairs = pair_turns(turns).select("conv_id", "turn", "query_turn")
    terms = turn_terms(turns)
    per_turn = terms.groupBy("conv_id", "turn").agg(
        F.sum("n").alias("n_tokens"), _share(F.col("n"), F.col("g")).alias("_grounded")
    )
    query_terms = terms.filter(F.col("role") == "user").select(
        "conv_id", F.col("turn").alias("query_turn"), "term", F.lit(1).alias("_said")
    )
    echo = (
        terms.filter(F.col("role") == "assistant")
        .join(pairs.filter(F.col("query_turn").isNotNull()), ["conv_id", "turn"])
        .join(query_terms, ["conv_id", "query_turn", "term"], "left")
        .groupBy("conv_id", "turn")
        .agg(_share(F.col("n"), F.coalesce("_said", F.lit(0))).alias("echo_mean"))
    )
    lanes = (
        pairs.join(
            per_turn.select("conv_id", "turn", F.col("_grounded").alias("reverse_context")),
            ["conv_id", "turn"],
            "left",
        )
        .join(
            per_turn.select(
                "conv_id",
                F.col("turn").alias("query_turn"),
                F.col("_grounded").alias("reverse_query_context"),
            ),
            ["conv_id", "query_turn"],
            "left",
        )
        .join(echo, ["conv_id", "turn"], "left")
    )
    product = F.col("reverse_context") * F.col("reverse_query_context") * F.col("echo_mean")
    return lanes.withColumn("triangular", r6(F.pow(product, F.lit(1.0 / 3.0))))


def token_echo(turns: DataFrame) -> DataFrame:
    """Tokens of each response with ``e_t``: 1 when its query holds the token, else 0,
    null without a query."""
    pairs = pair_turns(turns).select("conv_id", "turn", "query_turn", "response_text")
    said = (
        T.exploded(
            turns.filter(F.col("role") == "user").withColumnRenamed("turn", "query_turn"),
            ["conv_id", "query_turn"],
            T.distinct_tokens(F.col("text")),
            "term",
        ).withColumn("_said", F.lit(1))
    )
    positions = T.token_rows(pairs, ["conv_id", "turn"], "response_text")
    return (
        positions.withColumn("term", F.lower("token"))
        .join(pairs.select("conv_id", "turn", "query_turn"), ["conv_id", "turn"])
        .join(said, ["conv_id", "query_turn", "term"], "left")
        .select(
            "conv_id",
            "turn",
            "ix",
            "token",
            F.when(
                F.col("query_turn").isNotNull(), F.coalesce("_said", F.lit(0)).cast("double")
            ).alias("e_t"),
        )
    )


def query_tokens(turns: DataFrame) -> DataFrame:
    """Tokens of each user message: is the token in what preceded it."""
    users = turns.filter(F.col("role") == "user")
    origin = turn_terms(turns).filter(F.col("role") == "user").select("conv_id", "turn", "term", "g")
    return (
        T.token_rows(users, ["conv_id", "turn"], "text")
        .withColumn("term", F.lower("token"))
        .join(origin, ["conv_id", "turn", "term"])
        .select("conv_id", "turn", "ix", "token", F.col("g").cast("double").alias("in_context"))
    )


def shared_tokens(turns: DataFrame) -> DataFrame:
    """Terms found in a response, in its query and in what preceded that query."""
    pairs = pair_turns(turns).select("conv_id", "turn", "query_turn")
    terms = turn_terms(turns)
    key = ["conv_id", "turn", "query_turn", "term"]
    response = (
        terms.filter(F.col("role") == "assistant").join(pairs, ["conv_id", "turn"]).select(*key, "origin")
    )
    context = response.filter(F.col("origin") < F.col("query_turn")).select(*key)
    asked = terms.filter(F.col("role") == "user").select(
        "conv_id", F.col("turn").alias("query_turn"), "term"
    )
    query = response.join(asked, ["conv_id", "query_turn", "term"], "left_semi").select(*key)
    return response.select(*key).intersect(query).intersect(context).drop("query_turn")


def _micros(score: str) -> Column:
    return F.round(F.col(score) * 1_000_000).cast("bigint")


def drift(scores: DataFrame, key: str = "conv_id", order: str = "turn", score: str = "reverse_context") -> DataFrame:
    """Add ``z``: how far a score lies from the earlier ones of its session.

    Sums run over whole millionths, so the variance is exact in any order of
    addition; with fewer than two earlier scores or no spread ``z`` is 0.
    """
    exact = F.coalesce(_micros(score), F.lit(0)).cast("decimal(18,0)")
    running = scan.prefix(
        scores,
        [key],
        F.col(order),
        {
            "_n": ("sum", F.col(score).isNotNull().cast("bigint")),
            "_s": ("sum", exact),
            "_q": ("sum", (exact * exact).cast("decimal(28,0)")),
        },
    )
    n = F.col("_n").cast("double")
    spread = (
        F.col("_n").cast("decimal(18,0)") * F.col("_q").cast("decimal(38,0)")
        - F.col("_s").cast("decimal(19,0)") * F.col("_s").cast("decimal(19,0)")
    ).cast("double")
    deviation = F.sqrt(spread / (n * (n - 1)))
    mean = F.col("_s").cast("double") / n
    z = F.when(
        (F.col("_n") >= 2) & (spread > 0) & F.col(score).isNotNull(),
        (_micros(score).cast("double") - mean) / deviation,
    ).otherwise(0.0)
    return running.withColumn("z", r6(z)).drop("_n", "_s", "_q")


def drift_trend(scores: DataFrame, key: str = "conv_id", order: str = "turn", score: str = "reverse_context") -> DataFrame:
    """Lowest, highest, mean and last ``z`` of each session."""
    return (
        drift(scores, key, order, score)
        .groupBy(key)
        .agg(
            F.min("z").alias("z_min"),
            F.max("z").alias("z_max"),
            T.mean6(F.col("z")).alias("z_mean"),
            F.max_by("z", order).alias("z_last"),
        )
    )


def trajectory_features(scores: DataFrame) -> DataFrame:
    """Previous score, change, mean of the three before, rank in the session.

    The rank counts higher scores per distinct score: scores carry six decimals, so
    a session has at most 1,000,001 of them whatever its length.
    """
    key, order = ["conv_id"], F.col("turn")
    slim = scores.select("conv_id", "turn", "reverse_context")
    last = scan.prefix(
        slim, key, order, {"_last": ("max", F.struct("turn", "reverse_context"))}
    ).withColumn("_before", F.col("_last.reverse_context"))
    smooth = scan.trailing(
        last.drop("_last"), key, order, 3, {"_mean": _micros("reverse_context")}
    )
    higher = Window.partitionBy("conv_id").orderBy(F.desc("reverse_context"))
    ranks = (
        slim.filter(F.col("reverse_context").isNotNull())
        .groupBy("conv_id", "reverse_context")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "conv_id",
            "reverse_context",
            (
                F.coalesce(
                    F.sum("_n").over(higher.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
                )
                + 1
            ).alias("session_rank"),
        )
    )
    return smooth.join(ranks, ["conv_id", "reverse_context"], "left").select(
        "conv_id",
        "turn",
        "reverse_context",
        F.col("_before").alias("previous_score"),
        r6(F.col("reverse_context") - F.col("_before")).alias("score_delta"),
        (F.floor(F.col("_mean") + 0.5) / 1_000_000).alias("mean_of_last_three"),
        "session_rank",
        F.concat_ws(
            ",",
            F.when(F.col("_before").isNull(), "previous_score"),
            F.when(F.col("_mean").isNull(), "mean_of_last_three"),
        ).alias("missing_groups"),
    )


def band_trail(scores: DataFrame) -> DataFrame:
    """The bands of a session in order, as runs: a run per change of band.

    Runs keep the whole trail in order without collecting a session into one value. The
    starts of runs are read twice, so they are written to the shared folder once.
    """
    key, order = ["conv_id"], F.col("turn")
    before = scan.prefix(
        scores.select("conv_id", "turn", "band"), key, order, {"_last": ("max", F.struct("turn", "band"))}
    ).withColumn("_starts", F.coalesce(F.col("_last.band") != F.col("band"), F.lit(True)).cast("bigint"))
    starts = materialise(before.drop("_last"), "run-starts")
    numbered = scan.prefix(starts, key, order, {"_runs": ("sum", F.col("_starts"))})
    return numbered.groupBy(
        "conv_id", (F.col("_runs") + F.col("_starts") - 1).alias("run_ix"), "band"
    ).agg(
        F.min("turn").alias("first_turn"),
        F.max("turn").alias("last_turn"),
        F.count(F.lit(1)).alias("n_turns"),
    )


def band_rollup(scores: DataFrame, key: str = "conv_id") -> DataFrame:
    """Counts and share per session and band, with totals per session and overall."""
    finest = scores.groupBy(key, "band").agg(F.count(F.lit(1)).alias("_n"))
    sized = finest.withColumn("_all", F.sum("_n").over(Window.partitionBy(key)))
    rolled = sized.rollup(key, "band").agg(
        F.sum("_n").alias("n"), F.max("_all").alias("_all"), F.grouping_id().alias("grouping_id")
    )
    return rolled.select(
        key,
        "band",
        "n",
        r6(F.when(F.col("grouping_id") == 0, F.col("n") / F.col("_all")).otherwise(1.0)).alias("share"),
        "grouping_id",
    )


def _ownership(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files of a conversation (one per turn) and what responses took from them.

    ``files``: first response a file can serve (``first_response``) and how many
    responses there are (``responses``). ``taken``: ``owner_share`` of a file in the
    responses that used it, and the position of that response.
    """
    counted = scan.prefix(
        turns.select("conv_id", "turn", "role"),
        ["conv_id"],
        F.col("turn"),
        {"_before": ("sum", (F.col("role") == "assistant").cast("bigint"))},
    )
    totals = turns.groupBy("conv_id").agg(F.count_if(F.col("role") == "assistant").alias("responses"))
    files = counted.join(totals, "conv_id").select(
        "conv_id",
        F.col("turn").alias("file_turn"),
        F.concat(F.lit("turn_"), F.col("turn")).alias("path"),
        (F.col("_before") + (F.col("role") == "assistant").cast("bigint") + 1).alias("first_response"),
        "responses",
    )
    used = turn_terms(turns).filter((F.col("role") == "assistant") & (F.col("g") == 1))
    grounded = used.groupBy("conv_id", "turn").agg(F.sum("n").alias("_grounded"))
    taken = (
        used.groupBy("conv_id", "turn", F.col("origin").alias("file_turn"))
        .agg(F.sum("n").alias("_owned"))
        .join(grounded, ["conv_id", "turn"])
        .join(
            counted.filter(F.col("role") == "assistant").select(
                "conv_id", "turn", (F.col("_before") + 1).alias("response_ix")
            ),
            ["conv_id", "turn"],
        )
        .select(
            "conv_id",
            "file_turn",
            "response_ix",
            (F.col("_owned") / F.col("_grounded")).alias("owner_share"),
        )
    )
    return files, taken


def file_usage(turns: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Per file: responses it could serve, those that ignored it, and the moving
    average of its owner share.

    An exponential average is a weighted sum: a share counts ``alpha`` (the first
    one 1) times ``1 - alpha`` per later response. Responses that took nothing add
    zero, so only actual uses are looked at and nothing is folded in order.
    """
    files, taken = _ownership(turns)
    usable = files.filter(F.col("first_response") <= F.col("responses"))
    weight = F.pow(F.lit(1 - alpha), F.col("responses") - F.col("response_ix")) * F.when(
        F.col("response_ix") == F.col("first_response"), 1.0
    ).otherwise(alpha)
    return (
        usable.join(taken, ["conv_id", "file_turn"], "left")
        .groupBy("conv_id", "file_turn", "path", "first_response", "responses")
        .agg(
            F.count("owner_share").alias("used_turns"),
            F.coalesce(F.sum(F.col("owner_share") * weight), F.lit(0.0)).alias("_ema"),
        )
        .select(
            "conv_id",
            "path",
            (F.col("responses") - F.col("first_response") + 1 - F.col("used_turns")).alias("dead_turns"),
            "used_turns",
            r6(F.col("_ema")).alias("ema_owner_share"),
        )
    )


def top_dead_files(usage: DataFrame, limit: int = 3) -> DataFrame:
    """The files a session ignored most often."""
    worst = Window.partitionBy("conv_id").orderBy(F.desc("dead_turns"), F.asc("path"))
    return (
        usage.filter(F.col("dead_turns") > 0)
        .withColumn("rank", F.row_number().over(worst))
        .filter(F.col("rank") <= limit)
        .select("conv_id", F.col("rank").cast("bigint").alias("rank"), "path", "dead_turns", "ema_owner_share")
    )


def session_rollup(turns: DataFrame, drift_below: float = -2.0) -> DataFrame:
    """Turns, noise (amber or unknown), drift (z below -2) and waste (files never used).

    Drift reads its scores twice, so they are written to the shared folder once.
    """
    scored = (
        drift(materialise(turn_scores(turns), "scores"))
        .groupBy("conv_id")
        .agg(
            F.count(F.lit(1)).alias("turns"),
            r6(F.avg(F.col("band").isin("amber", "unknown").cast("double"))).alias("noise_pct"),
            r6(F.avg((F.col("z") < drift_below).cast("double"))).alias("model_drift_pct"),
        )
    )
    waste = (
        file_usage(turns)
        .groupBy("conv_id")
        .agg(r6(F.avg((F.col("used_turns") == 0).cast("double"))).alias("retrieval_waste_pct"))
    )
    return scored.join(waste, "conv_id", "left").withColumn(
        "retrieval_waste_pct", F.coalesce("retrieval_waste_pct", F.lit(0.0))
    )


def recommendations(rollup: DataFrame) -> DataFrame:
    """What to do about a session, from its rollup."""
    return rollup.select(
        rollup.columns[0],
        F.concat_ws(
            ";",
            F.when(F.col("retrieval_waste_pct") > 0.5, "rerank top-k"),
            F.when(F.col("model_drift_pct") > 0.2, "review model drift"),
            F.when(F.col("noise_pct") > 0.5, "tighten retrieval"),
        ).alias("recommendations"),
    )


def reason_histogram(scores: DataFrame, amber_at: float = AMBER_AT, green_at: float = GREEN_AT) -> DataFrame:
    """How often each reason code occurs in a session, as a map. There are seven codes."""
    decided = runtime_decision(
        scores.select(
            "conv_id",
            F.col("reverse_context").alias("score"),
            "band",
            F.lit(amber_at).alias("amber_at"),
            F.lit(green_at).alias("green_at"),
            F.lit(False).alias("allow_disabled"),
            F.lit(False).alias("block_disabled"),
        )
    )
    return (
        decided.select("conv_id", F.explode("reason_codes").alias("code"))
        .groupBy("conv_id", "code")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("conv_id")
        .agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "n")))).alias(
                "reason_code_histogram"
            )
        )
    )


def dedup_events(events: DataFrame, session: str, key: str, order: list[str]) -> DataFrame:
    """First event per session and key; an event without a key is never a repeat.

    The first row is an aggregate, combined before the shuffle, so a key with very
    many repeats sends one row per task.
    """
    rest = [c for c in events.columns if c not in (session, key)]
    first = (
        events.filter(F.col(key).isNotNull())
        .groupBy(session, key)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(session, key, "_row.*")
    )
    return first.unionByName(events.filter(F.col(key).isNull()))


def session_snapshot(
    events: DataFrame, session: str, order: str, event: Column, page_size: int = 100
) -> DataFrame:
    """Ordered events of each session in pages of fixed size.

    Pages in order are the snapshot; no page grows with its session.
    """
    placed = scan.prefix(
        events.select(session, order, event.alias("_event")),
        [session],
        F.col(order),
        {"_position": ("count", F.lit(1))},
    )
    page = F.floor(F.col("_position") / page_size)
    return (
        placed.groupBy(session, page.alias("page_ix"))
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.array_sort(F.collect_list(F.struct("_position", "_event"))).alias("_events"),
        )
        .select(
            session,
            "page_ix",
            "n_events",
            F.transform("_events", lambda e: e["_event"]).alias("events"),
        )
    )


def gap_sessions(events: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """Sessions of events no further apart than ``gap_seconds``.

    Events inside one bucket as wide as the gap always belong together, so events
    are reduced to one row per bucket first. What is ordered per key is bounded by
    the covered time over the gap, not by the number of events.
    """
    seconds = epoch_micros(ts) / 1_000_000
    buckets = (
        events.select(key, seconds.alias("_s"))
        .groupBy(key, F.floor(F.col("_s") / gap_seconds).alias("_bucket"))
        .agg(F.min("_s").alias("_first"), F.max("_s").alias("_last"), F.count(F.lit(1)).alias("_n"))
    )
    in_order = Window.partitionBy(key).orderBy("_bucket")
    opens = F.coalesce(F.col("_first") - F.lag("_last").over(in_order) >= gap_seconds, F.lit(True))
    return (
        buckets.withColumn("_opens", opens.cast("bigint"))
        .withColumn("_session", F.sum("_opens").over(in_order))
        .groupBy(key, "_session")
        .agg(
            F.min("_first").alias("_start"),
            F.max("_last").alias("_end"),
            F.sum("_n").alias("n_events"),
        )
        .select(
            key,
            F.floor(F.col("_start")).alias("start_s"),
            F.floor(F.col("_end") + gap_seconds).alias("end_s"),
            "n_events",
        )
    )
