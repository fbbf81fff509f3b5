"""Groundedness of responses against support units.

Inputs are two tables: ``responses(resp_id, response_text)`` and
``units(resp_id, unit_ix, source_id, text)``. Everything meets on
``(resp_id, term)`` after tokenising; a token is never compared with all others.
The scores are lexical measures defined here, not a hosted model's numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from types import SimpleNamespace
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from plumbline.functions import skew
from plumbline.functions import text as T
from plumbline.functions.batches import NO_IX, changes, cut, known_weights, weigh, whole_groups
from plumbline.functions.meet import meet
from plumbline.functions.text import mean6, r6
from plumbline.operators import similarity
from plumbline.session import materialise, materialise_all

MIN_RUN = 3
COVERAGE_THRESHOLD = 0.3
USED_AT = 0.5
UNCERTAIN_AT = 0.2


def _big(column: Column) -> Column:
    return column.cast("bigint")


TERMS = "_terms"
TOKENS = "_tokens"


def tokenised(responses: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with their terms, written once to the shared folder.

    Every lane of a score starts from the same terms. Where several lanes are wanted,
    they read the written arrays instead of cutting the texts again.
    """
    return tuple(
        materialise_all(
            {
                "responses": responses.withColumn(TOKENS, T.tokens(F.col("response_text"))),
                "units": units.withColumn(TERMS, T.distinct_tokens(F.col("text"))),
            }
        )
    )


def term_array(units: DataFrame) -> Column:
    return F.col(TERMS) if TERMS in units.columns else T.distinct_tokens(F.col("text"))


def _token_array(responses: DataFrame, text: str = "response_text") -> Column:
    return F.col(TOKENS) if TOKENS in responses.columns else T.tokens(F.col(text))


def unit_terms(units: DataFrame) -> DataFrame:
    """``resp_id, unit_ix, term``: distinct terms of each unit."""
    return T.exploded(units, ["resp_id", "unit_ix"], term_array(units), "term")


def context_terms(units: DataFrame) -> DataFrame:
    """``resp_id, term``: distinct terms of all units of a response."""
    return unit_terms(units).select("resp_id", "term").distinct()


def response_terms(responses: DataFrame, text: str = "response_text") -> DataFrame:
    """``resp_id, term, n``: terms of each response with their count."""
    return (
        T.exploded(responses, ["resp_id"], _token_array(responses, text), "term")
        .groupBy("resp_id", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def document_frequency(terms: DataFrame) -> DataFrame:
    """``term, df`` from one row per (unit, term)."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


_COUNTED: WeakKeyDictionary[DataFrame, tuple[DataFrame, int]] = WeakKeyDictionary()


def frequencies(units: DataFrame) -> tuple[DataFrame, int]:
    """``term, df`` written to the shared folder and the number of units; once for units that :func:`tokenised` has written."""
    if units in _COUNTED:
        return _COUNTED[units]
    counted = materialise(document_frequency(unit_terms(units)), "frequencies"), units.count()
    if TERMS in units.columns:
        _COUNTED[units] = counted
    return counted


def idf(df: Column, total: Column) -> Column:
    """Smoothed inverse frequency; an unseen term has ``df`` 0."""
    return F.log((total + 1) / (F.coalesce(df, F.lit(0)) + 1)) + 1


def weighted(terms: DataFrame, units: DataFrame, spread: list[str]) -> DataFrame:
    """Add ``weight``, the idf of each row's term over the unit table."""
    total = units.agg(F.count(F.lit(1))).scalar()
    found = skew.lookup(terms, document_frequency(unit_terms(units)), "term", "df", spread)
    return found.withColumn("weight", idf(F.col("df"), total)).drop("df")


def weighted_terms(responses: DataFrame, units: DataFrame) -> DataFrame:
    """``resp_id, term, n, weight``."""
    return weighted(response_terms(responses), units, ["resp_id", "term"])


def _texts_and_terms(responses: DataFrame, units: DataFrame) -> DataFrame:
    """``resp_id, response_text, _all``: texts and the units' packed terms, dealt by response; once for plans that ask for several results."""
    none = F.lit(None).cast("string")
    said = responses.select("resp_id", "response_text", none.alias("_all"))
    held = units.select("resp_id", none.alias("response_text"), T.packed(term_array(units)).alias("_all"))
    return said.unionByName(held).repartition("resp_id")


def _said_or_held(responses: DataFrame, units: DataFrame) -> DataFrame:
    """``resp_id, term, n, g`` of all terms of responses (``n`` times) and units (``g`` 1)."""
    rows = _texts_and_terms(responses, units).withColumn("_held", F.col("_all").isNotNull().cast("int"))
    terms = F.when(F.col("_held") == 0, T.tokens(F.col("response_text"))).otherwise(T.unpacked(F.col("_all")))
    return (
        T.exploded(rows, ["resp_id", "_held"], terms, "term")
        .groupBy("resp_id", "term")
        .agg(F.count_if(F.col("_held") == 0).alias("n"), _big(F.max("_held")).alias("g"))
    )


def grounded_terms(responses: DataFrame, units: DataFrame) -> DataFrame:
    """``resp_id, term, n, g``: ``g`` is 1 when a unit of the response holds the term."""
    return _said_or_held(responses, units.filter(F.col("resp_id").isNotNull())).filter(F.col("n") > 0)


def grounded_positions(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Tokens of each response with offsets and ``g_t`` (1 grounded, 0 not).

    Texts and the units' terms travel by response and are only then cut: windows by
    response need no shuffle after it.
    """
    parts = F.when(F.col("_all").isNull(), T.token_parts(F.col("response_text"), T.running_totals)).otherwise(
        F.transform(T.unpacked(F.col("_all")), lambda t: F.struct(t.alias("token"), F.lit(None).cast("bigint").alias("end")))
    )
    rows = T.positions(_texts_and_terms(responses, units.filter(F.col("resp_id").isNotNull())), ["resp_id"], parts, "ix", "_part")
    end, token = F.col("_part.end"), F.col("_part.token")
    same = Window.partitionBy("resp_id", "term")
    return (
        rows.withColumn("term", F.when(end.isNull(), token).otherwise(F.lower(token)))
        .withColumn("g_t", F.max(end.isNull().cast("double")).over(same))
        .filter(end.isNotNull())
        .select("resp_id", "term", "ix", token.alias("token"), (end - F.length(token)).alias("char_start"), end.alias("char_end"), "g_t")
    )


def matched(items: DataFrame, units: DataFrame) -> DataFrame:
    """``items(resp_id, term, ...)`` with ``unit_ix`` of each unit of their response that holds the term."""
    held = units.select("resp_id", "unit_ix", T.packed(term_array(units)).alias("_all"))
    return meet(items.withColumnRenamed("term", "_all"), held, "resp_id", "_all", "term")


UNIT, RARE, SAID, FOUND = range(4)


def _by_response(
    responses: DataFrame, units: DataFrame, fields: list[StructField], body: Callable[[SimpleNamespace], dict], more: DataFrame | None = None
) -> DataFrame:
    """``fields`` that ``body`` makes of batches of whole responses, see :func:`_meet_terms`.

    Units and what a response says travel once, by response, terms packed, and no row is made per pair.
    Weights of terms that hold more than one row in 10,000 are known to every task, rarer ones
    follow their response. Plans that ask for several results deal these rows once. ``more``
    holds rows of another kind, ``resp_id, _all, _share``. Rows without an id are left out.
    """
    frequency, total = frequencies(units)
    frequent = skew.frequent(frequency, "term", "df")
    hot = frequent.collect()
    rare = (
        T.exploded(responses, ["resp_id"], F.array_distinct(_token_array(responses)), "term")
        .join(F.broadcast(frequent.select("term")), "term", "left_anti")
        .join(frequency, "term")
    )
    source = F.col("source_id") if "source_id" in units.columns else F.lit(None).cast("string")
    none = F.lit(None)
    shaped = {
        UNIT: units.select("resp_id", F.coalesce("unit_ix", F.lit(NO_IX)).alias("_n"), T.packed(term_array(units)).alias("_all"), source.alias("source_id")),
        RARE: rare.select("resp_id", _big(F.col("df")).alias("_n"), F.col("term").alias("_all")),
        SAID: responses.select("resp_id", none.cast("bigint").alias("_n"), T.packed(_token_array(responses)).alias("_all")),
    }
    if more is not None:
        shaped[FOUND] = more
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("_tag", F.lit(tag)) for tag, df in shaped.items()])
    schema = StructType([rows.schema["resp_id"], *fields])
    arrow = to_arrow_schema(schema)
    # fewer than 10,000 terms, whatever the input
    known = responses.sparkSession.sparkContext.broadcast(([r["term"] for r in hot], [r["df"] for r in hot]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, df = pa.array(known.value[0], pa.string()), np.array(known.value[1], np.float64)
        weights = np.log((total + 1) / (df + 1)) + 1
        for table in whole_groups(batches, "resp_id"):
            out = body(_meet_terms(table, terms, weights, total))
            at = out.pop("at")
            columns = [table.column("resp_id").combine_chunks().take(pa.array(at)), *(out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name]) for f in fields)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.filter(F.col("resp_id").isNotNull()).repartition("resp_id").sortWithinPartitions("resp_id").mapInArrow(run, schema)


def _meet_terms(table: pa.Table, known: pa.Array, weights: np.ndarray, total: int) -> SimpleNamespace:
    """Terms of whole responses with their units.

    A pair is a response and one of its terms: ``pair_at`` is a row of it, ``term`` and ``met`` its term, ``n`` the
    times it is said, ``weight`` its weight. Row ``row`` of the units is unit ``unit_of``, of which
    ``overlap`` is the weight of what it shares with its response, added up over
    equal numbers. ``hit`` and ``holder`` are pairs and the units that hold them.
    """
    resp, tag, number = changes([table.column("resp_id")]), table.column("_tag").to_numpy(), table.column("_n").fill_null(0).to_numpy()
    terms, row = cut(table.column("_all"))
    encoded = terms.dictionary_encode()
    code, size = encoded.indices.to_numpy().astype(np.int64), len(encoded.dictionary)
    met = resp[row].astype(np.int64) * max(size, 1) + code
    held, rare, said = (tag[row] == t for t in (UNIT, RARE, SAID))
    pair, first, n = np.unique(met[said], return_index=True, return_counts=True)
    weight = weigh(pair, size, known_weights(encoded.dictionary, known, weights, total), met[rare], number[row[rare]], total)
    # units of one response and number are one
    at_unit = np.flatnonzero(tag == UNIT)
    order = at_unit[np.lexsort((number[at_unit], resp[at_unit]))]
    new = np.ones(len(order), bool)
    new[1:] = (resp[order][1:] != resp[order][:-1]) | (number[order][1:] != number[order][:-1])
    unit_of = np.zeros(len(tag), np.int64)
    unit_of[order] = np.cumsum(new) - 1
    place = np.searchsorted(pair, met[held])
    same = np.zeros(len(place), bool)
    inside = place < len(pair)
    same[inside] = pair[place[inside]] == met[held][inside]
    hit, holder = place[same], unit_of[row[held][same]]
    return SimpleNamespace(
        table=table, resp=resp, tag=tag, number=number, row=at_unit, unit_of=unit_of, unit_ix=number[order][new], code=code, size=size, met=met, terms=encoded.dictionary, at_term=row,
        pair=pair, pair_at=row[said][first], n=n, weight=weight, hit=hit, holder=holder, overlap=np.bincount(holder, weight[hit], int(new.sum())),
    )


def _unit_numbers(ix: np.ndarray) -> pa.Array:
    return pa.array(ix, mask=ix == NO_IX)


def _firsts(keys: np.ndarray, *orders: np.ndarray) -> np.ndarray:
    """Places of the first row of each key, in the order of ``orders``."""
    order = np.lexsort((*orders[::-1], keys))
    return order[np.concatenate([[True], np.diff(keys[order]) != 0])] if len(order) else order


def grounded_weights(responses: DataFrame, units: DataFrame) -> DataFrame:
    """``resp_id, term, n, g, weight``: :func:`grounded_terms` of responses with an id, weighted over the units."""

    def body(x: SimpleNamespace) -> dict:
        g = np.zeros(len(x.pair), np.int64)
        g[x.hit] = 1
        return {"at": x.pair_at, "term": x.terms.take(pa.array(x.pair % max(x.size, 1))), "n": x.n, "g": g, "weight": x.weight}

    fields = [StructField("term", StringType()), StructField("n", LongType()), StructField("g", LongType()), StructField("weight", DoubleType())]
    return _by_response(responses, units, fields, body)


def owners(responses: DataFrame, units: DataFrame) -> DataFrame:
    """``resp_id, term, j_star``: the unit that explains a term.

    Among the units holding it, the one covering most of the response, then the
    first. Overlaps are summed and the best unit chosen where a response and its units meet.
    """

    def body(x: SimpleNamespace) -> dict:
        best = _firsts(x.hit, -x.overlap.round(6)[x.holder], x.unit_ix[x.holder])
        term = x.terms.take(pa.array(x.pair[x.hit[best]] % max(x.size, 1)))
        return {"at": x.pair_at[x.hit[best]], "term": term, "j_star": _unit_numbers(x.unit_ix[x.holder[best]])}

    return _by_response(responses, units, [StructField("term", StringType()), StructField("j_star", LongType())], body)


def token_grounding(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Per token: offsets, ``g_t`` and the owning unit ``j_star`` (null if none)."""
    return (
        T.token_rows(responses, ["resp_id"], "response_text")
        .withColumn("term", F.lower("token"))
        .join(owners(responses, units), ["resp_id", "term"], "left")
        .select(
            "resp_id",
            "ix",
            "token",
            "char_start",
            "char_end",
            F.col("j_star").isNotNull().cast("double").alias("g_t"),
            "j_star",
        )
    )


def fuzzy_owners(responses: DataFrame, units: DataFrame, threshold: float = similarity.THRESHOLD) -> DataFrame:
    """``resp_id, term, matched_term, dice, j_star`` of response terms that no unit holds.

    ``matched_term`` is the term of the units most like it by :mod:`similarity`, at least
    ``threshold``; ``j_star`` the unit that holds it and covers most of the response.
    Equally similar terms: the better unit, then the first term.
    """
    missing = grounded_weights(responses, units).filter(F.col("g") == 0).select("resp_id", "term")
    held = units.select("resp_id", T.packed(term_array(units)).alias("term"))
    found = similarity.similar_terms(missing, held, "resp_id", threshold, packed=True)
    pairs = found.select("resp_id", T.packed(F.array("term", "matched_term")).alias("_all"), F.col("dice").alias("_share"))

    def body(x: SimpleNamespace) -> dict:
        size = max(x.size, 1)
        at = np.flatnonzero(x.tag == FOUND)
        wanted = x.code[x.tag[x.at_term] == FOUND].reshape(-1, 2)
        asked, matched_term = (x.resp[at].astype(np.int64) * size + wanted[:, k] for k in (0, 1))
        # the best unit that holds each matched term; one without a number has no overlap
        holds = np.flatnonzero((x.tag[x.at_term] == UNIT) & np.isin(x.met, matched_term))
        unit = x.unit_of[x.at_term[holds]]
        overlap = np.where(x.unit_ix == NO_IX, 0.0, x.overlap.round(6))
        best = _firsts(x.met[holds], -overlap[unit], x.unit_ix[unit])
        place = np.searchsorted(x.met[holds][best], matched_term)
        unit = unit[best][place]
        dice = x.table.column("_share").to_numpy()[at]
        in_order = np.empty(x.size, np.int64)
        in_order[pc.sort_indices(x.terms).to_numpy()] = np.arange(x.size)
        first = _firsts(asked, -dice, -overlap[unit], x.unit_ix[unit], in_order[wanted[:, 1]])
        term, similar = (x.terms.take(pa.array(wanted[first, k])) for k in (0, 1))
        return {"at": at[first], "term": term, "matched_term": similar, "dice": dice[first], "j_star": _unit_numbers(x.unit_ix[unit[first]])}

    fields = [StructField("term", StringType()), StructField("matched_term", StringType()), StructField("dice", DoubleType()), StructField("j_star", LongType())]
    return _by_response(responses, units, fields, body, pairs)


def token_grounding_fuzzy(
    responses: DataFrame, units: DataFrame, threshold: float = similarity.THRESHOLD
) -> DataFrame:
    """:func:`token_grounding` with a second step for tokens that no unit holds.

    Their ``g_t`` is the Dice coefficient of the most similar term of the units, 0 below
    ``threshold``; ``matched_term`` names that term (null where the token itself was found).
    """
    exact = owners(responses, units).select("resp_id", "term", F.lit(None).cast("string").alias("matched_term"), F.lit(1.0).alias("dice"), "j_star")
    best = exact.unionByName(fuzzy_owners(responses, units, threshold))
    # texts and owners travel by response; tokens are only then cut
    said = responses.select("resp_id", "response_text", F.lit(None).cast("string").alias("_term"))
    given = best.select("resp_id", F.col("term").alias("_term"), F.struct("dice", "matched_term", "j_star").alias("_best"))
    parts = F.when(F.col("_term").isNull(), T.token_parts(F.col("response_text"), T.running_totals)).otherwise(
        F.array(F.struct(F.col("_term").alias("token"), F.lit(None).cast("bigint").alias("end")))
    )
    rows = T.positions(said.unionByName(given, allowMissingColumns=True).repartition("resp_id"), ["resp_id", "_best"], parts, "ix", "_part")
    end, token = F.col("_part.end"), F.col("_part.token")
    return (
        rows.withColumn("term", F.when(end.isNull(), token).otherwise(F.lower(token)))
        .withColumn("_best", F.max("_best").over(Window.partitionBy("resp_id", "term")))
        .filter(end.isNotNull())
        .select(
            "resp_id",
            "ix",
            token.alias("token"),
            (end - F.length(token)).alias("char_start"),
            end.alias("char_end"),
            F.coalesce("_best.dice", F.lit(0.0)).alias("g_t"),
            F.col("_best.matched_term").alias("matched_term"),
            F.col("_best.j_star").alias("j_star"),
        )
    )


def unit_coverage(responses: DataFrame, units: DataFrame) -> DataFrame:
    """``resp_id, unit_ix, source_id, coverage``: the share of the response's idf
    mass (distinct terms) that each unit holds; units without overlap get 0."""

    def body(x: SimpleNamespace) -> dict:
        mass = np.bincount(x.resp[x.pair_at], x.weight, x.resp[-1] + 1)[x.resp[x.row]]
        overlap = np.where(x.number[x.row] == NO_IX, 0.0, x.overlap[x.unit_of[x.row]])
        share = np.divide(overlap, mass, out=np.zeros(len(mass)), where=mass > 0)
        return {"at": x.row, "unit_ix": _unit_numbers(x.number[x.row]), "source_id": x.table.column("source_id").combine_chunks().take(pa.array(x.row)), "coverage": share}

    fields = [units.schema["unit_ix"], units.schema["source_id"], StructField("coverage", DoubleType())]
    fields = [StructField(f.name, f.dataType) for f in fields]
    # no response is meant by a null id
    lost = units.filter(F.col("resp_id").isNull()).select("resp_id", "unit_ix", "source_id", F.lit(0.0).alias("coverage"))
    return _by_response(responses, units, fields, body).withColumn("coverage", r6(F.col("coverage"))).unionByName(lost)


def reverse_context(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Mean ``g_t`` per response."""
    return (
        grounded_terms(responses, units)
        .groupBy("resp_id")
        .agg(
            F.sum("n").alias("n_tokens"),
            r6(F.sum(F.col("n") * F.col("g")) / F.sum("n")).alias("reverse_context"),
        )
    )


def calibrated_context(responses: DataFrame, units: DataFrame) -> DataFrame:
    """``reverse_context`` corrected for what a foreign context would give.

    The null bank is *every other* response's context. The mean score against all
    of them is a sum over the response's terms of how many contexts hold the term,
    so one frequency table replaces any pairing of responses with contexts.
    """
    held = context_terms(units)
    contexts = held.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = units.agg(F.count_distinct("resp_id")).scalar()
    terms = skew.lookup(
        grounded_terms(responses, units), contexts, "term", "df", ["resp_id", "term"]
    )
    has_context = units.select("resp_id").distinct().withColumn("_own", F.lit(1))
    n, g = F.col("n"), F.col("g")
    scored = (
        terms.groupBy("resp_id")
        .agg(
            (F.sum(n * g) / F.sum("n")).alias("_x"),
            (F.sum(n * (F.coalesce("df", F.lit(0)) - g)) / F.sum("n")).alias("_foreign"),
        )
        .join(has_context, "resp_id", "left")
        .withColumn("null_bank_size", _big(total - F.coalesce("_own", F.lit(0))))
        .withColumn("_mu", F.try_divide("_foreign", "null_bank_size"))
    )
    return scored.select(
        "resp_id",
        r6(F.col("_x")).alias("reverse_context"),
        r6(F.col("_mu")).alias("null_mean"),
        r6(
            F.when(F.col("_mu").isNull(), F.col("_x"))
            .when(F.col("_mu") >= 1, 0.0)
            .otherwise(F.greatest(F.lit(0.0), (F.col("_x") - F.col("_mu")) / (1 - F.col("_mu"))))
        ).alias("reverse_context_calibrated"),
        "null_bank_size",
    )


def _runs(positions: DataFrame) -> DataFrame:
    """Number the runs of equal ``g_t`` in each response (gaps and islands)."""
    whole = Window.partitionBy("resp_id").orderBy("ix")
    alike = Window.partitionBy("resp_id", "g_t").orderBy("ix")
    return positions.withColumn("_run", F.row_number().over(whole) - F.row_number().over(alike))


def grounded_coverage(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Share of tokens in runs of at least three grounded tokens."""
    return (
        _runs(grounded_positions(responses, units))
        .groupBy("resp_id", "g_t", "_run")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("resp_id")
        .agg(
            r6(
                F.sum(
                    F.when((F.col("g_t") == 1) & (F.col("n") >= MIN_RUN), F.col("n")).otherwise(0)
                )
                / F.sum("n")
            ).alias("grounded_coverage")
        )
    )


def unsupported_spans(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Runs of ungrounded tokens with their character range."""
    return (
        _runs(grounded_positions(responses, units))
        .filter(F.col("g_t") == 0)
        .groupBy("resp_id", "_run")
        .agg(
            F.min("ix").alias("token_index"),
            F.count(F.lit(1)).alias("n_tokens"),
            F.min("char_start").alias("char_start"),
            F.max("char_end").alias("char_end"),
        )
        .drop("_run")
    )


def heatmap_spans(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Runs of equal score as spans, each with its escaped HTML fragment."""
    runs = (
        _runs(grounded_positions(responses, units))
        .groupBy("resp_id", "g_t", "_run")
        .agg(
            F.min("ix").alias("token_index"),
            F.min("char_start").alias("char_start"),
            F.max("char_end").alias("char_end"),
        )
    )
    piece = F.substring(
        F.col("response_text"),
        (F.col("char_start") + 1).cast("int"),
        (F.col("char_end") - F.col("char_start")).cast("int"),
    )
    escaped = F.replace(
        F.replace(F.replace(piece, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
        F.lit(">"),
        F.lit("&gt;"),
    )
    return runs.join(responses.select("resp_id", "response_text"), "resp_id").select(
        "resp_id",
        "token_index",
        "char_start",
        "char_end",
        F.col("g_t").alias("score"),
        F.concat(
            F.when(F.col("g_t") == 1, '<span class="grounded">').otherwise(
                '<span class="unsupported">'
            ),
            escaped,
            F.lit("</span>"),
        ).alias("html"),
    )


def coverage_stats(
    responses: DataFrame, units: DataFrame, threshold: float = COVERAGE_THRESHOLD
) -> DataFrame:
    """Unit-side coverage of each response; without units the counts are 0, the ratios null."""
    coverage = (
        unit_coverage(responses, units)
        .groupBy("resp_id")
        .agg(
            F.count(F.lit(1)).alias("n_units"),
            mean6(F.col("coverage")).alias("coverage_score_u"),
            r6(F.avg((F.col("coverage") >= threshold).cast("double"))).alias(
                "context_coverage_ratio"
            ),
        )
    )
    used = (
        owners(responses, units)
        .groupBy("resp_id")
        .agg(F.count_distinct("j_star").alias("context_attribution_used_count"))
    )
    return responses.select("resp_id").join(coverage, "resp_id", "left").join(used, "resp_id", "left").select(
        "resp_id",
        F.coalesce("n_units", F.lit(0)).alias("n_units"),
        "coverage_score_u",
        "context_coverage_ratio",
        F.lit(threshold).alias("context_coverage_threshold"),
        F.coalesce("context_attribution_used_count", F.lit(0)).alias(
            "context_attribution_used_count"
        ),
        r6(F.coalesce("context_attribution_used_count", F.lit(0)) / F.col("n_units")).alias(
            "context_attribution_ratio"
        ),
    )


def usage_states(
    responses: DataFrame,
    units: DataFrame,
    used_at: float = USED_AT,
    uncertain_at: float = UNCERTAIN_AT,
) -> DataFrame:
    """Units counted as used, uncertain or unused; the ratios sum to 1 (null without units)."""
    state = (
        F.when(F.col("coverage") >= used_at, "used")
        .when(F.col("coverage") >= uncertain_at, "uncertain")
        .otherwise("unused")
    )
    counted = (
        unit_coverage(responses, units)
        .withColumn("state", state)
        .groupBy("resp_id")
        .agg(
            F.count(F.lit(1)).alias("n_units"),
            *[
                F.count_if(F.col("state") == s).alias(f"context_{s}_count")
                for s in ("used", "uncertain", "unused")
            ],
        )
    )
    counts = [c for c in counted.columns if c != "resp_id"]
    return responses.select("resp_id").join(counted, "resp_id", "left").na.fill(0, counts).select(
        "*",
        *[
            r6(F.try_divide(F.col(f"context_{s}_count"), F.col("n_units"))).alias(f"context_{s}_ratio")
            for s in ("used", "uncertain", "unused")
        ],
        r6(F.try_divide(F.col("context_used_count"), F.col("n_units"))).alias("context_usage_ratio"),
    )


def file_attribution(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Per response and source: owned tokens, their share, whether it is dead."""
    owned = (
        owners(responses, units)
        .join(response_terms(responses), ["resp_id", "term"])
        .groupBy("resp_id", F.col("j_star").alias("unit_ix"))
        .agg(F.sum("n").alias("_owned"))
    )
    per_source = (
        units.select("resp_id", "unit_ix", "source_id", T.token_count(F.col("text")).alias("_size"))
        .join(owned, ["resp_id", "unit_ix"], "left")
        .groupBy("resp_id", "source_id")
        .agg(
            F.coalesce(F.sum("_owned"), F.lit(0)).alias("owned_tokens"),
            F.sum("_size").alias("source_tokens"),
        )
    )
    totals = per_source.groupBy("resp_id").agg(F.sum("owned_tokens").alias("_all"))
    return per_source.join(totals, "resp_id").select(
        "resp_id",
        "source_id",
        "owned_tokens",
        "source_tokens",
        r6(
            F.when(F.col("_all") > 0, F.col("owned_tokens") / F.col("_all")).otherwise(0.0)
        ).alias("owner_share"),
        (F.col("owned_tokens") == 0).alias("is_dead"),
    )


def dead_weight(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Share of context tokens in sources that own no token of the response (null without units)."""
    dead = (
        file_attribution(responses, units)
        .groupBy("resp_id")
        .agg(
            r6(
                F.sum(F.when(F.col("is_dead"), F.col("source_tokens")).otherwise(0))
                / F.sum("source_tokens")
            ).alias("dead_weight_ratio"),
            F.count_if("is_dead").alias("dead_weight_file_count"),
        )
    )
    return responses.select("resp_id").join(dead, "resp_id", "left").na.fill(0, ["dead_weight_file_count"])


def top_evidence(responses: DataFrame, units: DataFrame, limit: int = 3) -> DataFrame:
    """The ``limit`` best units per response. The rank filter prunes before the
    shuffle as well, so a response with very many units sends few."""
    best = Window.partitionBy("resp_id").orderBy(F.desc("coverage"), F.asc("unit_ix"))
    return (
        unit_coverage(responses, units)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= limit)
        .withColumn("rank", _big(F.col("rank")))
    )


def novel_tokens(responses: DataFrame, units: DataFrame) -> DataFrame:
    """Terms of a response that none of its units hold."""
    # null ids count as one here
    return _said_or_held(responses, units).filter((F.col("n") > 0) & (F.col("g") == 0)).select("resp_id", "term")


def query_context(queries: DataFrame, units: DataFrame) -> DataFrame:
    """``resp_id, query_context``: share of a query's tokens that its units hold."""
    asked = queries.filter(F.col("query_text").isNotNull()).select(
        "resp_id", F.col("query_text").alias("response_text")
    )
    return (
        grounded_terms(asked, units)
        .groupBy("resp_id")
        .agg(r6(F.sum(F.col("n") * F.col("g")) / F.sum("n")).alias("query_context"))
    )


def annotate_nodes(queries: DataFrame, units: DataFrame) -> DataFrame:
    """Score the retrieved units of a query as a whole; put the result on each unit.

    The score is the share of the query's tokens that its units hold. A unit that
    carries an ``annotation`` already keeps it; without a query nothing is added.
    """
    scored = query_context(queries, units)
    sizes = units.groupBy("resp_id").agg(F.count(F.lit(1)).alias("n_nodes"))
    fresh = scored.join(sizes, "resp_id").select(
        "resp_id",
        F.format_string(
            "query_context=%.4f;nodes=%d", F.col("query_context"), F.col("n_nodes")
        ).alias("_fresh"),
    )
    return units.join(fresh, "resp_id", "left").select(
        "resp_id", "unit_ix", F.coalesce("annotation", "_fresh").alias("annotation")
    )
