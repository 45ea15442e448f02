"""The refinement loop: score, share, choose elites, recombine, mutate, drop duplicates, and keep every round.

Sharing.  Designs whose smallest residue triple (by hash) is the same are a
niche; a design's fitness is its score less ``diversity_weight`` times the
logarithm of its niche's size, so a crowded family loses against a lone
design of nearly its score.

Children.  Every elite has as many; each takes a mate among the elites, a
cut point in both and the mutations after it by hashes of seed, round, parent
and number, so a rerun gives the same designs.  A share of the children by
hash has no mate and is mutated only.

Rounds are written, one table a round, and the whole population of each can
be queried; with a registry, each round's designs are also upserted there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.functions import sequences
from sievework.plans.shared import materialize
from sievework.sources.registry import Registry

#: Residues of the words that niches are made of.
WORD = 3


# Names and defaults of the loop's settings, but for the share of recombined children, which is ours.
@dataclass
class OptimizeConfig:
    """Settings of the refinement loop."""

    rounds: int = 6
    population: int = 256
    elite_frac: float = 0.1
    mutations_per_seq: tuple[int, int] = (1, 3)
    objective: str = "pdc_peptide"
    diversity_weight: float = 0.15
    seed: int = 0
    crossover: float = 0.5


def mutate(sequence: Column, n: Column, seed: Column, alphabet: str = sequences.ALPHABET) -> Column:
    """``n`` seeded point mutations, each at a place and to a residue drawn by hash; JVM-side."""

    def change(text: Column, turn: Column) -> Column:
        at = F.pmod(F.xxhash64(seed, turn, F.lit("place")), F.greatest(F.length(text), F.lit(1))) + 1
        old = F.instr(F.lit(alphabet), F.substr(text, at, F.lit(1)))
        step = F.pmod(F.xxhash64(seed, turn, F.lit("residue")), F.lit(len(alphabet) - 1)) + 1  # never the residue that was there
        to = F.pmod(old - 1 + step, F.lit(len(alphabet))) + 1
        return F.concat(F.substr(text, F.lit(1), at - 1), F.substr(F.lit(alphabet), to, F.lit(1)), F.substr(text, at + 1))

    return F.aggregate(F.sequence(F.lit(1), n), sequence, change)


def crossover(one: Column, other: Column, seed: Column) -> Column:
    """The first residues of ``one`` and the last of ``other``, cut at one place that both have; ``one`` if either has fewer than two."""
    short = F.least(F.length(one), F.length(other))
    at = F.pmod(F.xxhash64(seed, F.lit("cut")), F.greatest(short - 1, F.lit(1))) + 1
    return F.when(short >= 2, F.concat(F.substr(one, F.lit(1), at), F.substr(other, at + 1))).otherwise(one)


def niche(sequence: Column) -> Column:
    """The least hash of a sequence's words; that of the whole if it has none."""
    words = F.transform(F.sequence(F.lit(1), F.greatest(F.length(sequence) - WORD + 1, F.lit(1))), lambda i: F.xxhash64(F.substr(sequence, i, F.lit(WORD))))
    return F.array_min(words)


#: Cheap scores by objective: columns of sequence and a score that a predictor gave, if any.
OBJECTIVES: dict[str, Callable[[Column, Column], Column]] = {
    "pdc_peptide": lambda s, given: F.coalesce(given, F.lit(0.0)) - F.when(sequences.even_cysteines(s), 0.0).otherwise(0.5) - F.when(F.length(s) > 30, 0.5).otherwise(0.0),
    "vhh_cross_validated": lambda s, given: F.coalesce(given, F.lit(0.0)) - 0.1 * F.regexp_count(s, F.lit("N[^P][ST]|NG|NS|DG")),
}


def shared(population: DataFrame, score: Callable[[Column, Column], Column], weight: float) -> DataFrame:
    """Rows (sequence, given, ...) with score, niche, niche_size and fitness; each row's niche and score are computed once."""
    scored = materialize(population.withColumns({"score": score(F.col("sequence"), F.col("given")), "niche": niche(F.col("sequence"))}), "scored")
    sizes = materialize(scored.groupBy("niche").agg(F.count("*").alias("niche_size")), "niches")
    return scored.join(sizes, "niche").withColumn("fitness", F.col("score") - weight * F.log(F.col("niche_size").cast("double")))


def _children(elites: DataFrame, turn: int, config: OptimizeConfig) -> DataFrame:
    """Children (design_id, parent_id, mate_id, sequence, given) of the elites, whose number the settings bound."""
    low, high = config.mutations_per_seq
    ranked = elites.select("design_id", "sequence", "given", F.row_number().over(Window.orderBy(F.desc("fitness"), "design_id")).alias("rank"))
    many = ranked.count()
    each = -(-config.population // max(many, 1))
    draw = lambda *what, of: F.pmod(F.xxhash64("_seed", *map(F.lit, what)), F.lit(of))
    planned = ranked.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(each)))).withColumn("_seed", F.xxhash64(F.lit(config.seed), F.lit(turn), F.col("design_id"), F.col("_k")))
    mates = F.lit(many > 1) & (draw("mates", of=1000) < int(config.crossover * 1000))
    other = F.pmod(F.col("rank") - 1 + 1 + draw("mate", of=max(many - 1, 1)), F.lit(max(many, 1))) + 1  # any but itself
    planned = planned.withColumn("_mate", F.when(mates, other))
    mate = ranked.select(F.col("rank").alias("_mate"), F.col("design_id").alias("mate_id"), F.col("sequence").alias("_other"))
    paired = planned.join(F.broadcast(mate), "_mate", "left")
    crossed = F.when(F.col("_other").isNotNull(), crossover(F.col("sequence"), F.col("_other"), F.col("_seed"))).otherwise(F.col("sequence"))
    name = F.substring(F.sha2(F.concat_ws(":", "design_id", F.lit(turn), "_k"), 256), 1, 12)
    return paired.select(name.alias("design_id"), F.col("design_id").alias("parent_id"), "mate_id", mutate(crossed, draw("mutations", of=high - low + 1) + low, F.col("_seed")).alias("sequence"), "given")


def optimize(pool: DataFrame, config: OptimizeConfig, score: Callable[[Column, Column], Column] | None = None, registry: Registry | None = None, target_id: str = "") -> DataFrame:
    """The populations of all rounds from rows (design_id, sequence, given): children name their parent and mate.

    ``score`` maps the columns sequence and given to a score; ``given`` of a
    child is its parent's.  Returns (design_id, parent_id, mate_id, sequence,
    given, niche, score, niche_size, fitness, elite, round).
    """
    score, history = score or OBJECTIVES[config.objective], None
    now = pool.select("design_id", *[F.lit(None).cast("string").alias(c) for c in ("parent_id", "mate_id")], "sequence", F.col("given").cast("double"))
    now = now.repartition("design_id")  # a pool may come in few files; and its expressions end here instead of within each word of a niche
    elites_of = max(1, round(config.population * config.elite_frac))
    fields = ["design_id", "parent_id", "mate_id", "sequence", "given"]
    for turn in range(config.rounds):
        rated = shared(now, score, config.diversity_weight)
        elites = materialize(rated.orderBy(F.desc("fitness"), "design_id").limit(elites_of), f"elites-{turn}")
        marked = rated.join(F.broadcast(elites.select("design_id", F.lit(True).alias("elite"))), "design_id", "left").withColumns({"elite": F.coalesce("elite", F.lit(False)), "round": F.lit(turn)})
        marked = materialize(marked.select(*fields, "niche", "score", "niche_size", "fitness", "elite", "round"), f"round-{turn}")
        if registry is not None:
            registry.upsert(snapshot(marked, target_id, config.objective))
        history = marked if history is None else history.unionByName(marked)
        grown = elites.select(*fields).unionByName(_children(elites, turn, config))
        order = F.struct(F.col("parent_id").isNotNull().alias("new"), *[c for c in fields if c != "sequence"])
        now = grown.groupBy("sequence").agg(F.min(order).alias("r")).select(*[F.col("sequence") if c == "sequence" else F.col(f"r.{c}").alias(c) for c in fields])
    return history


def snapshot(marked: DataFrame, target_id: str, objective: str) -> DataFrame:
    """A round's designs as registry rows; what they scored is told in their metrics."""
    told = F.to_json(F.struct("score", "fitness", "niche_size", "round", "elite", "mate_id"))
    return marked.select(
        "design_id", F.lit(target_id).alias("target_id"), F.lit("peptide").alias("modality"), F.lit("optimize").alias("pipeline"), F.lit(objective).alias("config_hash"), "parent_id", "sequence",
        F.length("sequence").alias("length"), told.alias("metrics"), F.col("score").alias("final_score"), F.lit("optimize").alias("stage"),
    )


def convergence(history: DataFrame) -> DataFrame:
    """(round, designs, elites, mean, best, niches, largest_niche) of every round."""
    return history.groupBy("round").agg(
        F.count("*").alias("designs"), F.count_if("elite").alias("elites"), F.avg("score").alias("mean"), F.max("score").alias("best"),
        F.count_distinct("niche").alias("niches"), F.max("niche_size").alias("largest_niche"),
    )
