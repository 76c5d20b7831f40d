"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by source, language and topic, one row a cell. Shares of the cells in the drawn tokens are raked to each
marginal in turn until all three agree with their goals; no cell may get more than all its tokens, which is a bound in
every step, so probabilities need no clipping afterwards and the drawn mix itself meets the goals. If they can't all be met
at the budget, the budget is lowered. Documents are drawn by a hash of their id, so the same documents stay whatever the
partitions. All on Spark: what the driver gets is a handful of sums.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.work import Scratch
from .names import free_prefix

MARGINALS = ("source", "lang", "topic")
_SMALL = 10_000


#: Words of each topic in English, French, German and Spanish, lower case. Ties go to the topic listed first.
TOPICS = {
    "health": "doctor patient disease hospital medicine vaccine symptoms therapy médecin maladie hôpital santé arzt krankheit krankenhaus gesundheit médico enfermedad salud",
    "science": "physics chemistry biology experiment theory laboratory research scientist physique chimie recherche physik chemie forschung física química investigación",
    "technology": "software computer internet algorithm database server programming code logiciel ordinateur rechner datenbank programm programa ordenador",
    "finance": "bank market stock investment interest economy money tax banque marché économie argent wirtschaft geld börse steuer banco mercado economía dinero",
    "law": "court judge lawsuit statute contract attorney crime tribunal juge avocat contrat gericht richter gesetz vertrag juez abogado contrato",
    "politics": "government election president parliament minister policy gouvernement élection président regierung wahl präsident gobierno elección presidente",
    "sport": "football team match player league coach championship équipe joueur entraîneur mannschaft spieler trainer equipo jugador entrenador",
    "culture": "music film novel artist museum theatre poetry musique roman artiste musée musik künstler theater música película artista museo",
    "education": "school student teacher university lesson exam école élève professeur université schule schüler lehrer universität escuela alumno profesor universidad",
    "travel": "hotel flight airport tourist beach passport journey vol aéroport voyage plage flug flughafen reise strand vuelo aeropuerto viaje playa",
}


def topic_of(text: Column) -> Column:
    """The topic of ``TOPICS`` with the most different words in the text. Without any, as null and empty texts: other."""
    words = {name: sorted(set(known.split())) for name, known in TOPICS.items()}
    listed = lambda known: F.array(*[F.lit(w) for w in known])
    found = F.array_intersect(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), listed(sorted({w for known in words.values() for w in known})))
    entry = lambda n, i, name: F.struct(n.alias("n"), F.lit(-i).alias("i"), F.lit(name).alias("name"))
    best = lambda has: F.greatest(entry(F.lit(0), -1, "other"), *[entry(F.size(F.array_intersect(has, listed(known))), i, name) for i, (name, known) in enumerate(words.items())])
    return F.transform(F.array(found), best)[0]["name"]


def rake(cells: DataFrame, targets: dict[str, DataFrame], scratch: Scratch, most_rounds: int = 40, near: float = 1e-4) -> tuple[DataFrame, float]:
    """cells (the marginals' columns, ``w`` and, if it is bounded, ``most``) with ``w`` fitted, and the largest gap that remains
    between a marginal's share and its goal: above ``near`` if the goals contradict each other or the bounds, or the rounds do
    not suffice. targets: by column, frames of that column and ``goal``.

    Goals are shares of the whole. A marginal value with tokens but no goal keeps its weight out of the fit: its goal is 0.
    """
    w, off, bounded = cells, 0.0, "most" in cells.columns
    for name, goal in targets.items():
        w = w.join(goal.withColumnRenamed("goal", f"goal_{name}"), name, "left")
    w, start = scratch.keep(w), 0
    small = w.count() <= _SMALL
    # goals of values that no cell has can't be met by any fit
    unmet = [goal.join(w.select(name).distinct(), name, "left_anti").select("goal") for name, goal in targets.items()]
    missed = reduce(DataFrame.unionAll, unmet).agg(F.max("goal")).first()[0] or 0.0
    sums = {name: F.sum("w").over(Window.partitionBy(name)) for name in targets}
    goals = {name: F.coalesce(f"goal_{name}", F.lit(0.0)) for name in targets}
    while start < most_rounds:
        w = w.coalesce(1) if small else w  # few cells: the sums of a round need no exchange
        for _ in range(min(4, most_rounds - start)):
            for name in targets:
                fitted = F.when(F.col("sum") > 0, F.col("w") * goals[name] / F.col("sum")).otherwise(0.0)
                w = w.withColumn("sum", sums[name]).withColumn("w", F.least(fitted, "most") if bounded else fitted).drop("sum")
            start += 1
        # the gaps are written with the weights, so that a round of sums is one job
        w = scratch.keep(w.withColumn("gap", F.array_max(F.array(*[F.abs(sums[name] - goals[name]) for name in targets]))))
        before, off = off, max(missed, w.agg(F.max("gap")).first()[0] or 0.0)
        w = w.drop("gap")
        if off < near or (before and off > 0.98 * before):
            break
    return w.drop(*[f"goal_{name}" for name in targets]), off


def tempered(cells: DataFrame, name: str, power: float, most_gain: float) -> DataFrame:
    """Goals proportional to natural shares to a power, but at most ``most_gain`` natural shares: below 1, small sources gain."""
    sums = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("t")).where("t > 0")
    whole = sums.agg(F.sum("t")).first()[0] or 1.0
    sums = sums.select(name, (F.col("t") / whole).alias("s")).withColumn("g", F.pow("s", F.lit(power)))
    scale = 1 / (sums.agg(F.sum("g")).first()[0] or 1.0)
    for _ in range(20):  # what the bound takes from some values, the others share
        at = sums.agg(F.sum(F.when(F.lit(scale) * F.col("g") < F.lit(most_gain) * F.col("s"), F.col("g"))).alias("free"), F.sum(F.when(F.lit(scale) * F.col("g") >= F.lit(most_gain) * F.col("s"), F.lit(most_gain) * F.col("s"))).alias("bound")).first()
        new = (1 - (at["bound"] or 0.0)) / at["free"] if at["free"] else scale
        if abs(new - scale) < 1e-12 * scale:
            break
        scale = new
    goal = F.least(F.lit(scale) * F.col("g"), F.lit(most_gain) * F.col("s"))
    whole = sums.agg(F.sum(goal)).first()[0] or 1.0
    return sums.select(name, (goal / whole).alias("goal"))


def mixing_probabilities(documents: DataFrame, powers: dict[str, float] | None = None, budget: float = 0.8, seed: int = 11, goals: dict[str, dict[str | None, float]] | None = None) -> DataFrame:
    """``documents`` with ``_topic``, ``_tokens`` (runs of non-white-space), ``_weight`` (its cell's share of the drawn tokens against
    its natural share), ``_probability``, ``_drawn``, ``_gap`` (the fit's largest distance of a marginal's share from its goal) and
    ``_budget``. Where ``documents`` has such names, see ``free_prefix``.

    goals: by marginal (source, lang, topic), shares by value that are to be met; a value without a share gets none, and shares
    are scaled to 1. A marginal without goals gets natural shares to its power (0.7), at most 1 / budget of a natural share.
    budget: expected share of all tokens that is drawn. If goals can't be met at it, as some values have too few tokens, it is
    lowered in steps of a fifth until they are met or eight steps are done; ``_gap`` then tells what remains.

    Null sources and languages are values of their own. A text without words, as null and empty texts, counts one token; long
    texts count whole. Repeated rows are drawn alike, a null doc_id like one id. No documents: no rows.
    """
    scratch, p = Scratch(documents.sparkSession), free_prefix(documents)
    powers = {"source": 0.7, "lang": 0.7, "topic": 0.7} | (powers or {})
    text = F.col("text").cast("string")
    tokens = F.greatest(F.coalesce(F.regexp_count(text, F.lit(r"[^\s\x1c-\x1f\x85\p{Z}]+")), F.lit(0)), F.lit(1)).cast("long")
    own = {"source": f"{p}source", "lang": f"{p}lang", "topic": f"{p}topic"}
    plain = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = documents.withColumns({own["source"]: plain("source"), own["lang"]: plain("lang"), own["topic"]: topic_of(text), f"{p}tokens": tokens})
    cells = scratch.keep(rows.groupBy(*[F.col(own[name]).alias(name) for name in MARGINALS]).agg(F.sum(f"{p}tokens").alias("tokens")))
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return rows.drop(own["source"], own["lang"]).withColumns({f"{p}weight": F.lit(1.0), f"{p}probability": F.lit(1.0), f"{p}drawn": F.lit(True), f"{p}gap": F.lit(0.0), f"{p}budget": F.lit(1.0)})
    start = scratch.keep(cells.withColumn("s", F.col("tokens") / float(total)))

    def goal_of(name: str) -> DataFrame:
        if not (goals or {}).get(name):
            return scratch.keep(tempered(cells, name, powers[name], 1 / budget))
        shares = {v if name == "topic" else "" if v is None else f"={v}": g for v, g in goals[name].items()}
        return documents.sparkSession.createDataFrame([(v, g / sum(shares.values())) for v, g in shares.items()], f"{name} string, goal double")

    targets = {name: goal_of(name) for name in MARGINALS}
    for _ in range(8):
        fitted, gap = rake(start.withColumn("w", F.col("s")).withColumn("most", F.col("s") / budget), targets, scratch)
        if gap < 1e-4:
            break
        budget *= 0.8
    table = fitted.select(*[F.col(name).alias(own[name]) for name in MARGINALS], (F.col("w") / F.col("s")).alias(f"{p}weight"), F.least(F.lit(1.0), F.lit(budget) * F.col("w") / F.col("s")).alias(f"{p}probability"))
    out = rows.join(table, list(own.values()), "left").select(*documents.columns, own["topic"], f"{p}tokens", f"{p}weight", f"{p}probability")
    dice = F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    return out.withColumns({f"{p}drawn": F.coalesce(dice < F.col(f"{p}probability"), F.lit(False)), f"{p}gap": F.lit(float(gap)), f"{p}budget": F.lit(float(budget))})
