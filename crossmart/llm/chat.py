"""Chat formatting: a hidden Markov model recovers the speaker of every turn, which is then rendered.

States are roles; a turn is observed through its speaker marker and line features. The model
is counted from labelled turns. Viterbi works on max-plus matrices, which are associative: a
conversation is cut into chunks of turn numbers, every chunk becomes one small matrix, chunks
of chunks again, until one matrix is left. The best path is then fixed from the top down, so a
conversation of any length needs no task that sees all of its turns.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmart.llm.common import stage, unit_hash

ROLES = ("system", "user", "assistant")
#: Speaker markers at the start of a turn, by role; a colon, a closing bracket or a line end closes them. Fixed values.
MARKERS = (
    ("system", r"(?is)^\s*(?:\[|<\|?|#+\s*|\*\*)?(?:system)(?:\]|\|?>|\*\*)?\s*[:>\]\n]\s*"),
    ("user", r"(?is)^\s*(?:\[|<\|?|#+\s*|\*\*)?(?:user|human|customer|question|prompt|instruction|q)(?:\]|\|?>|\*\*)?\s*[:>\]\n]\s*"),
    ("assistant", r"(?is)^\s*(?:\[|<\|?|#+\s*|\*\*)?(?:assistant|bot|ai|agent|answer|response|a)(?:\]|\|?>|\*\*)?\s*[:>\]\n]\s*"),
)
WORD_STEPS = (4, 8, 16, 32, 48, 64, 96, 128, 192, 256)
OBSERVATIONS = (len(MARKERS) + 1) * (len(WORD_STEPS) + 1) * 4
CHUNK = 256
SAMPLE_CONVERSATIONS = 20_000


def observation(text: Column) -> Column:
    """A turn's features as one number: marker, steps of its number of words, question, many lines."""
    body = F.coalesce(text, F.lit(""))
    marker = F.lit(0)
    for i, (_, pattern) in enumerate(MARKERS):
        marker = F.when(body.rlike(pattern), i + 1).otherwise(marker)
    n = F.size(F.filter(F.split(body, r"[\x20\x09-\x0D]+", -1), lambda w: w != ""))
    step = F.lit(0)
    for limit in WORD_STEPS:
        step = step + F.when(n > limit, 1).otherwise(0)
    asks = F.when(body.rlike(r"\?\s*$"), 1).otherwise(0)
    lines = F.when(F.size(F.split(body, "\n", -1)) > 2, 1).otherwise(0)
    return ((marker * (len(WORD_STEPS) + 1) + step) * 4 + asks * 2 + lines).cast("int")


class Model:
    """Log-probabilities: ``emit[state, observation]`` and ``move[state or start, state]``."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move


def train(turns: DataFrame) -> Model:
    """Count a model from (conv, turn, pos, role, obs) rows whose role is known; half a count is added to each.

    Only a table of roles by observations and one of roles by roles reach the driver. A
    marker is worth as many prior counts for its own role, so markers tell roles even where
    the sample has none. Moves are counted inside chunks of turn numbers, starts in the first.
    """
    known = turns.where(F.col("role").isin(*ROLES))
    emit = np.full((len(ROLES), OBSERVATIONS), 0.5)
    share = OBSERVATIONS // (len(MARKERS) + 1)
    for s in range(len(ROLES)):
        emit[s, (s + 1) * share : (s + 2) * share] += 50.0
    for r in known.groupBy("role", "obs").count().collect():
        emit[ROLES.index(r["role"]), r["obs"]] += r["count"]
    move = np.full((len(ROLES) + 1, len(ROLES)), 0.5)
    chunk = F.floor(F.coalesce("turn", F.lit(0)) / CHUNK)
    rows = known.groupBy("conv", chunk.alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("turn", "pos", "role"))).alias("xs"))
    before = F.element_at("xs", F.greatest(F.col("i"), F.lit(1)))["role"]
    steps = rows.select("chunk", "xs", F.posexplode("xs").alias("i", "x")).where("i > 0 OR chunk = 0").select(F.struct(
        F.when(F.col("i") > 0, before).otherwise(F.lit("")).alias("a"), F.col("x.role").alias("b")).alias("s"))
    for r in steps.groupBy("s.a", "s.b").count().collect():
        move[ROLES.index(r["a"]) if r["a"] else len(ROLES), ROLES.index(r["b"])] += r["count"]
    return Model(np.log(emit / emit.sum(axis=1, keepdims=True)), np.log(move / move.sum(axis=1, keepdims=True)))


def best_path(steps: np.ndarray, enter: int, leave: int | None = None) -> list[int]:
    """States after each (states + 1) x states matrix on the best path; ties go to the lower state."""
    score, back = steps[0][enter], []
    for m in steps[1:]:
        through = score[:, None] + m[: len(ROLES)]
        back.append(through.argmax(axis=0))
        score = through.max(axis=0)
    path = [int(score.argmax()) if leave is None else leave]
    for choice in reversed(back):
        path.append(int(choice[path[-1]]))
    return path[::-1]


def product(steps: np.ndarray) -> np.ndarray:
    """The max-plus product: best score from every entering state (or the start) to every leaving state."""
    out = steps[0]
    for m in steps[1:]:
        out = (out[:, :, None] + m[None, : len(ROLES)]).max(axis=1)
    return out


def decoded(turns: DataFrame, model: Model) -> DataFrame:
    """(conv, turn, pos, role): the Viterbi role of every row of (conv, turn, pos, obs).

    ``turn`` is a number from 0; ``pos`` settles the order of equal turns. Groups hold the
    turns, or chunks, of ``CHUNK`` consecutive numbers.
    """
    shape = (-1, len(ROLES) + 1, len(ROLES))

    @F.pandas_udf("array<double>")
    def matrix(values: pd.Series) -> pd.Series:
        return pd.Series([product(np.array(v, dtype=float).reshape(shape)).ravel() for v in values.map(lambda x: np.concatenate(list(x)))])

    @F.pandas_udf("array<double>")
    def leaf(values: pd.Series) -> pd.Series:
        return pd.Series([(model.move + model.emit[:, o][None, :]).ravel() for o in values])

    @F.pandas_udf("array<int>")
    def states(values: pd.Series, enter: pd.Series, leave: pd.Series) -> pd.Series:
        return pd.Series([
            best_path(np.array(np.concatenate(list(v)), dtype=float).reshape(shape), int(i), None if j is None or j != j else int(j))
            for v, i, j in zip(values, enter, leave, strict=True)])

    level = stage(turns.select("conv", F.col("turn").cast("long").alias("turn"), "pos", leaf("obs").alias("m")), "turns")
    top = level.agg(F.max("turn").alias("t")).first()["t"] or 0
    levels = [level]
    while top > 0 or len(levels) == 1:
        grouped = levels[-1].groupBy("conv", F.floor(F.col("turn") / CHUNK).alias("turn")).agg(
            F.sort_array(F.collect_list(F.struct("turn", "pos", "m"))).alias("xs"))
        levels.append(stage(grouped.select("conv", "turn", F.lit(0).alias("pos"), "xs", matrix("xs.m").alias("m")), "chunks"))
        top //= CHUNK
    fixed = levels[-1].select("conv", "turn", F.lit(len(ROLES)).alias("enter"), F.lit(None).cast("int").alias("leave"))
    for above in reversed(levels[1:]):
        found = above.join(fixed, ["conv", "turn"]).select("conv", "xs", "enter", states("xs.m", "enter", "leave").alias("path"))
        spread = found.select("conv", "enter", "path", F.posexplode("xs").alias("i", "x"))
        before = F.when(F.col("i") == 0, F.col("enter")).otherwise(F.element_at("path", F.greatest(F.col("i"), F.lit(1))))
        fixed = stage(spread.select(
            "conv", F.col("x.turn").alias("turn"), F.col("x.pos").alias("pos"), before.alias("enter"),
            F.element_at("path", F.col("i") + 1).alias("leave")), "path")
    return fixed.select("conv", "turn", "pos", F.element_at(F.array(*map(F.lit, ROLES)), F.col("leave") + 1).alias("role"))


def rendered(role: Column, text: Column) -> Column:
    """The canonical turn: role line, text without the marker of that role, once, and outer white space, end mark."""
    body = F.coalesce(text, F.lit(""))
    shown = body
    for name, pattern in MARKERS:
        shown = F.when(role == name, F.regexp_replace(body, pattern, "")).otherwise(shown)
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), F.regexp_replace(shown, r"^\s+|\s+$", ""), F.lit("\n<|end|>\n"))


def formatted(
    turns: DataFrame, labelled: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text", sample: int = SAMPLE_CONVERSATIONS,
) -> DataFrame:
    """(conv_id, turn, role, rendered, given_role): recovered roles and canonical turns.

    Roles in the table are only used to count the model, from an expected ``sample`` of the
    conversations of ``labelled`` (default: the table). Equal rows are one turn; turns without
    a number come first, equal numbers in the order of their text; a turn without a
    conversation is a conversation of its own. A null text is an empty turn. Without any
    labelled turn, markers and alternation of nothing else decide.
    """
    labelled = turns if labelled is None else labelled

    def prepared(df):
        own = df.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")).distinct()
        alone = F.concat(F.lit("alone:"), F.md5(F.concat_ws(":", "turn", "role", "text")))
        named = F.when(F.col("conv_id").isNull(), alone).otherwise(F.concat(F.lit("id:"), F.col("conv_id").cast("string")))
        return own.select("*", named.alias("conv"), F.md5(F.concat_ws(":", F.coalesce("text", F.lit("")), F.coalesce("role", F.lit("")))).alias("pos"), observation(F.col("text")).alias("obs"))

    known = prepared(labelled)
    share = F.lit(float(sample)) / F.greatest(F.lit(1), F.lit(known.select("conv").distinct().count()))
    model = train(known.where(unit_hash(F.lit("chat"), F.col("conv")) < share))
    rows = stage(prepared(turns), "chat")
    lowest = rows.agg(F.min("turn").alias("t")).first()["t"] or 0
    placed = rows.withColumn("at", F.coalesce(F.col("turn") - lowest + 1, F.lit(0)))
    roles = decoded(placed.select("conv", F.col("at").alias("turn"), "pos", "obs"), model)
    found = placed.withColumnRenamed("role", "given_role").join(roles.withColumnRenamed("turn", "at"), ["conv", "at", "pos"])
    return found.select("conv_id", "turn", "role", rendered(F.col("role"), F.col("text")).alias("rendered"), "given_role")
