"""Claims and atoms of a response, checked against its support units.

A lexical stand-in for an entailment model: overlap in idf mass, turned into a
contradiction when negation or numbers disagree with the best premise. A user
model plugs in as the ``scorer`` of :func:`verify`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from plumbline.functions import skew
from plumbline.functions import text as T
from plumbline.functions.batches import NO_IX, changes, cut, known_weights, weigh, whole_groups
from plumbline.functions.text import mean6, r6
from plumbline.operators import grounding as G
from plumbline.operators.literals import literal_counts
from plumbline.session import materialise

# Words that flip a statement, in the languages of the corpora.
NEGATIONS = (
    "not no never none neither nor cannot without "
    "ne pas jamais sans "
    "nicht kein keine nie ohne "
    "nunca sin tampoco"
).split()
NUMBER = r"[0-9]+(?:\.[0-9]+)?"
GREEN_AT = 0.7
RED_BELOW = 0.3
CONTRADICTION_FLOOR = 0.5
BLOCK = 1 << 22


def _big(column: Column) -> Column:
    return column.cast("bigint")


def split_claims(responses: DataFrame) -> DataFrame:
    """``resp_id, claim_ix, text, char_start, char_end``."""
    return T.piece_rows(
        responses, ["resp_id"], "response_text", T.SEGMENT_END
    ).withColumnRenamed("ix", "claim_ix")


def split_atoms(claims: DataFrame) -> DataFrame:
    """``resp_id, claim_ix, atom_ix, text, char_start, char_end``, offsets in the response."""
    return T.piece_rows(
        claims, ["resp_id", "claim_ix"], "text", T.ATOM_END, F.col("char_start")
    ).withColumnRenamed("ix", "atom_ix")


def _negations(text: Column) -> Column:
    return F.size(F.filter(T.tokens(text), lambda t: t.isin(*NEGATIONS)))


def _numbers(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0)))


def _facts(text: Column) -> list[Column]:
    return [(_negations(text) % 2).alias("parity"), _numbers(text).alias("numbers")]


def best_premises(items: DataFrame, units: DataFrame, ids: list[str], corpus: DataFrame, premises: int, block: int = BLOCK) -> DataFrame:
    """Items that share a term with a unit of their response: ``resp_id, ids, _mass, _overlap, unit_ix, _premises``.

    ``items`` have their distinct terms in ``TERMS``. ``_mass`` is the weight of an item's terms,
    ``_overlap`` that of those ``unit_ix`` holds, the best unit; ``_premises`` lists the best units.

    Items and units travel once, by response, their terms packed. Weights of terms that hold more than
    one row in 10,000 are known to every task, rarer ones follow their response. A task
    holds a batch of whole responses and adds up their overlaps some ``block`` sums at a time.
    """
    keys = ["resp_id", *ids]
    spark = items.sparkSession
    frequency, total = G.frequencies(corpus)
    frequent = skew.frequent(frequency, "term", "df")
    hot = frequent.collect()
    rare = (
        T.exploded(items, ["resp_id"], F.col(G.TERMS), "term")
        .join(F.broadcast(frequent.select("term")), "term", "left_anti")
        .join(frequency, "term")
    )
    none = F.lit(None)
    places = [items.schema[k] for k in ids]
    shaped = {
        # units without a number come first in the order of units, as nulls do
        0: units.select("resp_id", F.coalesce("unit_ix", F.lit(NO_IX)).alias("_n"), T.packed(G.term_array(units)).alias("_all"), *(none.cast(f.dataType).alias(f.name) for f in places)),
        1: rare.select("resp_id", _big(F.col("df")).alias("_n"), F.col("term").alias("_all"), *(none.cast(f.dataType).alias(f.name) for f in places)),
        2: items.select("resp_id", F.lit(0).cast("bigint").alias("_n"), T.packed(F.col(G.TERMS)).alias("_all"), *ids),
    }
    rows = reduce(DataFrame.unionByName, [df.withColumn("_tag", F.lit(tag)) for tag, df in shaped.items()])
    schema = StructType(
        [
            rows.schema["resp_id"],
            *places,
            StructField("_mass", DoubleType()),
            StructField("_premises", ArrayType(LongType())),
            StructField("_overlaps", ArrayType(DoubleType())),
        ]
    )
    arrow = to_arrow_schema(schema)
    # fewer than 10,000 terms, whatever the input
    known = spark.sparkContext.broadcast(([r["term"] for r in hot], [r["df"] for r in hot]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, df = pa.array(known.value[0], pa.string()), np.array(known.value[1], np.float64)
        for table in whole_groups(batches, "resp_id"):
            found = overlaps(table, keys, terms, np.log((total + 1) / (df + 1)) + 1, total, premises, block)
            if found is not None:
                item, mass, ends, unit, overlap = found
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v)) for v in (unit, overlap)]
                columns = [table.column(k).combine_chunks().take(pa.array(item)) for k in keys]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*columns, pa.array(mass), *lists], arrow)], schema=arrow)

    placed = (
        rows.filter(F.col("resp_id").isNotNull())
        .repartition("resp_id")
        .sortWithinPartitions("resp_id", "_tag", *ids)
        .mapInArrow(run, schema)
    )
    return placed.select(
        *keys,
        "_mass",
        r6(F.col("_overlaps")[0]).alias("_overlap"),
        F.nullif(F.col("_premises")[0], F.lit(NO_IX)).alias("unit_ix"),
        F.transform("_premises", lambda ix: F.nullif(ix, F.lit(NO_IX))).alias("_premises"),
    )


def overlaps(table: pa.Table, keys: list[str], known: pa.Array, weights: np.ndarray, total: int, premises: int, block: int) -> tuple | None:
    """Best units of the items of whole responses, see :func:`best_premises`.

    Returns a row and the mass of each item with a unit, the ends of its list, and the lists' units and
    rounded overlaps; None without any. Equal keys are one item, equal numbers one unit.
    """
    resp, tag = changes([table.column("resp_id")]), table.column("_tag").to_numpy()
    terms, row = cut(table.column("_all"))
    encoded = terms.dictionary_encode()
    code, size = encoded.indices.to_numpy(), len(encoded.dictionary)
    met = resp[row].astype(np.int64) * max(size, 1) + code
    unit, rare, item = (tag[row] == t for t in (0, 1, 2))
    if not item.any() or not unit.any():
        return None
    # the weight of every item's term: hot ones by term, rare ones by response and term, the rest unseen
    weight = weigh(met[item], size, known_weights(encoded.dictionary, known, weights, total), met[rare], table.column("_n").to_numpy()[row[rare]], total)
    # numbers of items and units inside the table; those of one response are neighbours
    at_item, at_unit = np.flatnonzero(tag == 2), np.flatnonzero(tag == 0)
    item_of = np.zeros(len(tag), np.int64)
    item_of[at_item] = changes([table.column(k).take(pa.array(at_item)) for k in keys])
    first = at_item[np.concatenate([[True], np.diff(item_of[at_item]) > 0])]
    order = at_unit[np.lexsort((table.column("_n").to_numpy()[at_unit], resp[at_unit]))]
    pair = np.stack([resp[order], table.column("_n").to_numpy()[order]])
    new = np.concatenate([[True], (np.diff(pair, axis=1) != 0).any(axis=0)])
    unit_of = np.zeros(len(tag), np.int64)
    unit_of[order] = np.cumsum(new) - 1
    unit_ix = pair[1][new]
    lowest = np.searchsorted(pair[0][new], np.arange(resp[-1] + 2))  # the first unit of each response
    claim = item_of[row[item]]
    mass = np.bincount(claim, weight, len(first))
    # terms meet on response and term; blocks of whole items keep what is held small
    order = np.argsort(met[unit], kind="stable")
    held, holder = met[unit][order], unit_of[row[unit]][order]
    low, high = (np.searchsorted(held, met[item], side) for side in ("left", "right"))
    width = np.diff(lowest)[resp[first]]
    cost = np.cumsum(width + np.bincount(claim, high - low, len(first)))
    out: list[tuple] = []
    start = 0
    while start < len(first):
        stop = max(start + 1, int(np.searchsorted(cost, (cost[start - 1] if start else 0) + block, "right")))
        a, b = np.searchsorted(claim, [start, stop])
        n = high[a:b] - low[a:b]
        base = np.concatenate([[0], np.cumsum(width[start:stop])])
        places = np.repeat(low[a:b] - np.cumsum(n) + n, n) + np.arange(n.sum())
        mine = claim[a:b] - start
        cell = np.repeat(base[mine] - lowest[resp[first[claim[a:b]]]], n) + holder[places]
        sums = np.bincount(cell, np.repeat(weight[a:b], n), base[-1])
        hit = np.flatnonzero(sums)
        owner = np.searchsorted(base, hit, "right") - 1
        ix = unit_ix[hit - base[owner] + lowest[resp[first[start:stop]]][owner]]
        overlap = sums[hit].round(6)
        best = np.lexsort((ix, -overlap, owner))
        rank = np.arange(len(best)) - np.searchsorted(owner[best], owner[best])
        best = best[rank < premises]
        out.append((owner[best] + start, ix[best], overlap[best]))
        start = stop
    owner, ix, overlap = (np.concatenate(x) for x in zip(*out))
    if not len(owner):
        return None
    items, begins = np.unique(owner, return_index=True)
    return first[items], mass[items], np.append(begins, len(owner)), ix, overlap


def verify(
    items: DataFrame,
    units: DataFrame,
    ids: list[str],
    premises: int = 3,
    budget: int | None = None,
    corpus: DataFrame | None = None,
    scorer: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Verdict per item; ``ids`` are the item's positions inside its response.

    Items meet units on shared terms only. ``premise_ixs`` lists the best
    ``premises`` units. Items past ``budget`` (by the first position) are kept
    and marked as skipped. Term weights come from ``corpus``, or from ``units``.

    ``scorer(text, premise)``, a pandas UDF as a rule, gives a struct of
    ``entailment, contradiction`` for an item and its best premise in place of the
    lexical rule. It sees a null premise where there is none; that result is not used.
    """
    keys = ["resp_id", *ids]
    items = materialise(items.withColumn(G.TERMS, T.distinct_tokens(F.col("text"))), "items")
    weighed = items if budget is None else items.filter(F.col(ids[0]) < budget)
    ranked = best_premises(weighed, units, ids, units if corpus is None else corpus, premises)
    premise_facts = units.select(
        "resp_id",
        "unit_ix",
        F.struct(*_facts(F.col("text"))).alias("_premise"),
        F.col("text").alias("_premise_text"),
    )
    # what is known of the best unit joins the narrow rows, so an item's text travels once
    judged_by = ranked.join(premise_facts, ["resp_id", "unit_ix"], "left")
    joined = items.withColumn("_claim", F.struct(*_facts(F.col("text")))).join(judged_by, keys, "left")
    differs = (F.col("_claim.parity") != F.col("_premise.parity")) | (
        (F.size("_claim.numbers") > 0)
        & (F.size(F.array_except("_claim.numbers", "_premise.numbers")) > 0)
    )
    over_budget = F.lit(False) if budget is None else F.col(ids[0]) >= budget
    if scorer is None:
        judged = joined.withColumn("entailment", r6(F.col("_overlap") / F.col("_mass"))).withColumn(
            "contradiction", F.when(differs, F.col("entailment")).otherwise(F.col("entailment") * 0)
        )
    else:
        verdict = joined.withColumn("_verdict", scorer(F.col("text"), F.col("_premise_text")))
        judged = verdict.withColumns(
            {
                name: F.when(F.col("_premise_text").isNotNull(), r6(F.col("_verdict")[name]))
                for name in ("entailment", "contradiction")
            }
        )
    scored = (
        judged.withColumn(
            "neutral",
            F.when(
                F.col("entailment").isNotNull(),
                r6(F.greatest(F.lit(0.0), 1 - F.col("entailment") - F.col("contradiction"))),
            ),
        )
        .withColumn("score", r6(F.col("entailment") * (1 - F.col("contradiction"))))
        .withColumn(
            "skip_reason",
            F.when(over_budget, "budget").when(F.col("entailment").isNull(), "no_premises"),
        )
    )
    e, c, n = F.col("entailment"), F.col("contradiction"), F.col("neutral")
    return scored.select(
        *keys,
        "text",
        "char_start",
        "char_end",
        "entailment",
        "neutral",
        "contradiction",
        "score",
        F.when(F.col("skip_reason").isNotNull(), "skipped")
        .when((c >= CONTRADICTION_FLOOR) | (F.col("score") < RED_BELOW), "red")
        .when(F.col("score") >= GREEN_AT, "green")
        .otherwise("amber")
        .alias("band"),
        F.when(F.col("skip_reason").isNotNull(), None)
        .when((e >= c) & (e >= n), "entailment")
        .when(c >= n, "contradiction")
        .otherwise("neutral")
        .alias("label"),
        "skip_reason",
        F.col("unit_ix").alias("premise_index"),
        F.array_join(F.transform("_premises", lambda ix: ix.cast("string")), ",").alias("premise_ixs"),
    )


def claim_verification(
    responses: DataFrame,
    units: DataFrame,
    premises: int = 3,
    budget: int | None = None,
    corpus: DataFrame | None = None,
    scorer: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Verdict per claim."""
    return verify(split_claims(responses), units, ["claim_ix"], premises, budget, corpus, scorer)


def atom_verification(
    responses: DataFrame,
    units: DataFrame,
    premises: int = 3,
    scorer: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Verdict per atom."""
    atoms = split_atoms(split_claims(responses))
    return verify(atoms, units, ["claim_ix", "atom_ix"], premises, scorer=scorer)


def lift_atoms(atoms: DataFrame) -> DataFrame:
    """Atom verdicts lifted to their claim."""
    return atoms.groupBy("resp_id", "claim_ix").agg(
        F.count(F.lit(1)).alias("n_atoms"),
        F.count_if(F.col("band") == "green").alias("n_green"),
        F.count_if(F.col("band") == "red").alias("n_red"),
        mean6(F.col("score")).alias("atom_score"),
        r6(F.max("contradiction")).alias("atom_contradiction_max"),
    )


def claim_aggregates(claims: DataFrame) -> DataFrame:
    """Claim diagnostics per response."""
    return claims.groupBy("resp_id").agg(
        mean6(F.col("score")).alias("nli_aggregate"),
        F.count(F.lit(1)).alias("n_claims"),
        F.count("score").alias("n_scored"),
        F.count_if(F.col("skip_reason") == "no_premises").alias("skipped_no_premises"),
        F.count_if(F.col("skip_reason") == "budget").alias("skipped_budget"),
        F.count_if(F.col("band") == "green").alias("n_supported"),
        F.max("contradiction").alias("contradiction_prob_max"),
    )


def _weighted_mean(lanes: dict[str, float]) -> Column:
    top = [F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in lanes.items()]
    bottom = [F.when(F.col(c).isNotNull(), w).otherwise(0.0) for c, w in lanes.items()]
    total = reduce(lambda a, b: a + b, bottom)
    return F.when(total > 0, reduce(lambda a, b: a + b, top) / total)


def _half_up(value: Column) -> Column:
    """Six decimals by plain arithmetic: means of rounded lanes often end in a tie."""
    return F.floor(value * 1_000_000 + 0.5) / 1_000_000


LANE_WEIGHTS = {"groundedness_v1": 0.5, "nli_aggregate": 0.3, "literal_match_ratio": 0.2}
DISAGREEMENT = 0.3


def lanes(
    responses: DataFrame, units: DataFrame, scorer: Callable[[Column, Column], Column] | None = None
) -> DataFrame:
    """The single-lane scores of each response; null where a lane does not apply."""

    terms = G.grounded_weights(responses, units)
    mass = F.col("n") * F.col("weight")
    token_lane = terms.groupBy("resp_id").agg(
        r6(F.sum(mass * F.col("g")) / F.sum(mass)).alias("groundedness_v1"),
        r6(F.sum(F.col("n") * F.col("g")) / F.sum("n")).alias("reverse_context"),
    )
    claim_lane = claim_aggregates(claim_verification(responses, units, scorer=scorer)).select(
        "resp_id", "nli_aggregate", "n_claims", "contradiction_prob_max"
    )
    literal_lane = literal_counts(responses, units).select(
        "resp_id",
        r6(F.try_divide("literal_match", "literal_total")).alias("literal_match_ratio"),
    )
    return (
        responses.select("resp_id")
        .join(token_lane, "resp_id", "left")
        .join(claim_lane, "resp_id", "left")
        .join(literal_lane, "resp_id", "left")
    )


def fuse(scored: DataFrame, primary_metric: str = "groundedness_v2") -> DataFrame:
    """``groundedness_v2`` (weights renormalised over the lanes present), the score
    named by ``primary_metric`` and the consensus of the lanes."""
    names = list(LANE_WEIGHTS)
    spread = F.greatest(*names) - F.least(*names)
    return (
        scored.withColumn("groundedness_v2", _half_up(_weighted_mean(LANE_WEIGHTS)))
        .withColumn(
            "fusion_weights_applied",
            F.concat_ws(
                ",",
                *[
                    F.when(F.col(c).isNotNull(), F.lit(f"{c}={w}"))
                    for c, w in LANE_WEIGHTS.items()
                ],
            ),
        )
        .withColumn("primary_name", F.lit(primary_metric))
        .withColumn("primary_score", F.col(primary_metric))
        .withColumn(
            "consensus_hardened",
            F.when(r6(spread) > DISAGREEMENT, F.least(*names)).otherwise(F.col("groundedness_v2")),
        )
    )


def cascade(
    responses: DataFrame, units: DataFrame, amber_at: float = 0.2, green_at: float = 0.35
) -> DataFrame:
    """Claim verification only for responses whose cheap first-pass band is amber."""
    first = G.reverse_context(responses, units).withColumn(
        "first_band",
        F.when(F.col("reverse_context") >= green_at, "green")
        .when(F.col("reverse_context") >= amber_at, "amber")
        .otherwise("red"),
    )
    unsure = first.filter(F.col("first_band") == "amber").select("resp_id")
    checked = claim_aggregates(
        claim_verification(
            responses.join(unsure, "resp_id", "left_semi"),
            units.join(unsure, "resp_id", "left_semi"),
            corpus=units,
        )
    ).select("resp_id", "nli_aggregate")
    settled = first.filter(F.col("first_band") != "amber").select(
        "resp_id",
        "first_band",
        F.lit(False).alias("nli_cascade_triggered"),
        F.lit(None).cast("double").alias("nli_aggregate"),
        F.col("reverse_context").alias("score"),
        F.col("first_band").alias("band"),
    )
    # half millionths go up: whole millionths are added as integers
    micros = sum(F.round(F.col(c) * 1_000_000).cast("bigint") for c in ("reverse_context", "nli_aggregate"))
    mixed = F.coalesce(F.floor((micros + 1) / 2) / 1_000_000, F.col("reverse_context"))
    escalated = (
        first.filter(F.col("first_band") == "amber")
        .join(checked, "resp_id", "left")
        .withColumn("score", mixed)
        .select(
            "resp_id",
            "first_band",
            F.lit(True).alias("nli_cascade_triggered"),
            "nli_aggregate",
            "score",
            F.when(F.col("score") >= green_at, "green")
            .when(F.col("score") >= amber_at, "amber")
            .otherwise("red")
            .alias("band"),
        )
    )
    return settled.unionByName(escalated)
