"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is a run of pieces (conversation, seq, text); its lines are the
pieces' lines in order. Hidden states: each role, at the first line of a turn or
at a later one. A line is observed as its speaker marker (one of each role's
usual ones, or none), its length class and whether it ends in a question mark.
Start, transition and observation probabilities are counts of labelled lines, with
one added. Viterbi finds the most likely states; ties go to the first state.

Viterbi is a product of (max, +) matrices, so a conversation is cut into blocks
of ``BLOCK`` seq numbers: each block becomes one matrix, a pass over a
conversation's block matrices fixes the states at the cuts, and each block is
then decoded between them. The result is that of one pass; no task holds a
conversation's lines.

Null text has no lines, empty lines are none either; a piece of a null
conversation belongs to the conversation null. Null seq comes first. Pieces of equal
seq are ordered by text. Equal rows all count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import group_bounds, map_groups, stored

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # role * 2 + (0: a turn's first line, 1: a later line)
MARKERS = {
    "system": r"(?i)^\s*(?:#+\s*)?(?:system|sys|context)\s*[:>\]]+\s*",
    "user": r"(?i)^\s*(?:#+\s*)?(?:user|human|instruction|q)\s*[:>\]]+\s*",
    "assistant": r"(?i)^\s*(?:#+\s*)?(?:assistant|ai|bot|response|a)\s*[:>\]]+\s*",
}
SIZES = (60, 200)  # length classes of a line
OBSERVATIONS = (len(ROLES) + 1) * (len(SIZES) + 1) * 2
BLOCK = 1024


def marker_class(line: Column) -> Column:
    kind = F.lit(len(ROLES))
    for i, role in reversed(list(enumerate(ROLES))):
        kind = F.when(line.rlike(MARKERS[role]), i).otherwise(kind)
    return kind


def observation(line: Column) -> Column:
    size = F.lit(len(SIZES))
    for i, limit in reversed(list(enumerate(SIZES))):
        size = F.when(F.length(line) < limit, i).otherwise(size)
    asks = F.rtrim(line).endswith("?").cast("int")
    return ((marker_class(line) * (len(SIZES) + 1) + size) * 2 + asks).cast("int")


def lines(pieces: DataFrame, conv: str = "conv_id", seq: str = "seq", text: str = "text", extra: list[str] = ()) -> DataFrame:
    """(conv, seq, line_no, line, obs, ...) of all lines but empty ones."""
    cut = pieces.select(F.col(conv).alias("conv"), F.col(seq).cast("long").alias("seq"), *extra, F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line"))
    return cut.where(F.trim("line") != "").withColumn("obs", observation(F.col("line")))


# --- the model ----------------------------------------------------------------------

def fit(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probabilities (start, transitions, observations) of labelled pieces (conv_id, seq, text, role).

    The counts are tables of a fixed size: a few hundred rows reach the driver.
    """
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") - 1
    known = labelled.where(F.col("role").isin(*ROLES))
    rows = lines(known, extra=["role"]).withColumn("role_no", role)
    first = F.min("line_no").over(Window.partitionBy("conv", "seq"))
    rows = stored(rows.withColumn("state", F.col("role_no") * 2 + (F.col("line_no") > first).cast("int")).select("conv", "seq", "line_no", "state", "obs"), "labelled-lines")
    seen = np.ones((STATES, OBSERVATIONS))
    for r in rows.groupBy("state", "obs").count().collect():
        seen[r["state"], r["obs"]] += r["count"]
    # transitions inside a piece, and from a piece's last line to the next piece's first
    ends = rows.groupBy("conv", "seq").agg(F.min_by("state", "line_no").alias("head"), F.max_by("state", "line_no").alias("tail"), F.count("*").alias("n"))
    by = Window.partitionBy("conv", F.floor(F.col("seq") / BLOCK)).orderBy("seq")
    moves = ends.withColumn("before", F.lag("tail").over(by)).withColumn("starts", F.col("seq") == F.min("seq").over(by)).groupBy("before", "head", "tail", "starts").agg(
        F.count("*").alias("pieces"), F.sum("n").alias("n"))
    start, step = np.ones(STATES), np.ones((STATES, STATES))
    for r in moves.collect():
        if r["before"] is not None:
            step[r["before"], r["head"]] += r["pieces"]
        elif r["starts"]:
            start[r["head"]] += r["pieces"]
        later = r["n"] - r["pieces"]  # lines after a piece's first
        if later:
            step[r["head"], r["tail"]] += r["pieces"]
            step[r["tail"], r["tail"]] += later - r["pieces"] if r["tail"] % 2 else 0
    for i in range(0, STATES):
        for j in range(1, STATES, 2):
            if j // 2 != i // 2:
                step[i, j] = 1e-9  # a later line continues its own role's turn
    start[1::2] = 1e-9
    log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return log(start), log(step), log(seen)


def viterbi(first: np.ndarray, step: np.ndarray, seen: np.ndarray, last: int | None = None) -> np.ndarray:
    """Most likely states for ``seen`` (n, states), the observations' log probabilities.

    ``first``: log probabilities of the first line's state, ``last``: the last line's state, if it is known.
    """
    n = len(seen)
    back = np.zeros((n, len(first)), dtype="int64")
    score = first + seen[0]
    for i in range(1, n):
        ways = score[:, None] + step
        back[i] = ways.argmax(axis=0)
        score = ways.max(axis=0) + seen[i]
    path = np.empty(n, dtype="int64")
    path[-1] = score.argmax() if last is None else last
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def _entered(model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entered, step, seen): ``entered`` has the transitions out of each state, and in a last row the start of a conversation."""
    start, step, seen = model
    return np.vstack([step, start]), step, seen


def _block_matrices(model):
    entered, step, seen = _entered(model)

    def run(table: pa.Table):
        conv, block, obs = (table.column(c).to_numpy() for c in ("conv", "block", "obs"))
        bounds = group_bounds([conv, block])
        matrices = []
        for lo, hi in zip(bounds, bounds[1:]):
            score = entered + seen[:, obs[lo]]
            for o in obs[lo + 1:hi]:
                score = (score[:, :, None] + step[None]).max(axis=1) + seen[:, o]
            matrices.append(score.astype("<f8").tobytes())
        at = np.array(bounds[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(conv[at], pa.string()), pa.array(block[at], pa.int64()), pa.array(matrices, pa.binary())],
                                         names=["conv", "block", "matrix"])
    return run


def _cut_states(table: pa.Table):
    """The state before each block (STATES: the conversation's start) and at its end, on the conversation's best path."""
    conv = table.column("conv").to_numpy()
    matrices = np.frombuffer(b"".join(table.column("matrix").to_pylist()), "<f8").reshape(-1, STATES + 1, STATES)
    bounds = group_bounds([conv])
    before, end = np.empty(len(conv), dtype="int64"), np.empty(len(conv), dtype="int64")
    for lo, hi in zip(bounds, bounds[1:]):
        score, backs = np.append(np.full(STATES, -np.inf), 0.0), []
        for m in matrices[lo:hi]:
            ways = score[:, None] + m
            backs.append(ways.argmax(axis=0))
            score = np.append(ways.max(axis=0), -np.inf)
        state = int(score.argmax())
        for i in range(hi - 1, lo - 1, -1):
            end[i] = state
            before[i] = state = int(backs[i - lo][state])
    yield pa.RecordBatch.from_arrays([pa.array(conv, pa.string()), table.column("block").combine_chunks(), pa.array(before), pa.array(end)],
                                     names=["conv", "block", "before", "end"])


def _decoder(model, names):
    entered, step, seen = _entered(model)

    def run(table: pa.Table):
        conv, block, obs, before, end = (table.column(c).to_numpy() for c in ("conv", "block", "obs", "before", "end"))
        bounds = group_bounds([conv, block])
        states = np.empty(len(obs), dtype="int32")
        for lo, hi in zip(bounds, bounds[1:]):
            states[lo:hi] = viterbi(entered[before[lo]], step, seen.T[obs[lo:hi]], int(end[lo]))
        yield from table.select(names).append_column("state", pa.array(states)).combine_chunks().to_batches()
    return run


NO_CONVERSATION = "\u0000"  # stands for null


def decode(pieces: DataFrame, model, conv: str = "conv_id", seq: str = "seq", text: str = "text") -> DataFrame:
    """(conv, block, seq, line_no, line, obs, state) of every line; ``conv`` as a string."""
    rows = lines(pieces, conv, seq, text)
    rows = stored(rows.select(F.coalesce(F.col("conv").cast("string"), F.lit(NO_CONVERSATION)).alias("conv"),
                              F.floor(F.coalesce("seq", F.lit(-1)) / BLOCK).cast("long").alias("block"), "seq", "line_no", "line", "obs"), "lines")
    order = ["seq", "line_no", "line"]
    names = ["conv", "block", *order, "obs"]
    matrices = map_groups(rows, ["conv", "block"], _block_matrices(model), "conv string, block long, matrix binary", order)
    cuts = stored(map_groups(matrices, ["conv"], _cut_states, "conv string, block long, before long, end long", ["block"]), "cuts")
    shape = "conv string, block long, seq long, line_no int, line string, obs int, state int"
    return map_groups(rows.join(cuts, ["conv", "block"]).select(*names, "before", "end"), ["conv", "block"], _decoder(model, names), shape, order)


def without_marker(line: Column, role: Column) -> Column:
    out = line
    for r in ROLES:
        out = F.when(role == r, F.regexp_replace(line, MARKERS[r], "")).otherwise(out)
    return out


def turns(decoded: DataFrame) -> DataFrame:
    """(conv, seq, line_no, role, n_lines, text, rendered): a row per recovered turn, by the place of its first line.

    A turn whose lines run on into the next block is found by the last beginning before that block.
    """
    rows = stored(decoded.withColumn("begins", F.col("state") % 2 == 0), "decoded")
    here = F.struct("seq", "line_no", "line")
    by = Window.partitionBy("conv", "block").orderBy("seq", "line_no", "line").rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("own", F.last(F.when(F.col("begins"), here), ignorenulls=True).over(by))
    lasts = rows.where("begins").groupBy("conv", "block").agg(F.max(here).alias("last"))
    every = rows.select("conv", "block").distinct().join(lasts, ["conv", "block"], "left")
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    carried = every.select("conv", "block", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.floor(F.col("state") / 2).cast("int") + 1)
    kept = (marked.join(carried, ["conv", "block"]).withColumn("turn", F.coalesce("own", "carried")).withColumn("role", role)
            .withColumn("clean", F.when(F.col("begins"), without_marker(F.col("line"), F.col("role"))).otherwise(F.col("line"))))
    joined = kept.groupBy("conv", F.col("turn.seq").alias("seq"), F.col("turn.line_no").alias("line_no"), F.col("turn.line").alias("opening"), "role").agg(
        F.count("*").alias("n_lines"), F.array_sort(F.collect_list(F.struct("seq", "line_no", "clean"))).alias("parts"))
    text = F.trim(F.array_join("parts.clean", "\n"))
    return joined.select(F.when(F.col("conv") != NO_CONVERSATION, F.col("conv")).alias("conv"), "seq", "line_no", "role", "n_lines", text.alias("text"),
                         F.concat(F.lit("<|"), "role", F.lit("|>\n"), text, F.lit("\n<|end|>")).alias("rendered"))


# --- transcripts of the conversations table --------------------------------------------

STYLES = (("system: ", "user: ", "assistant: "), ("System> ", "Human> ", "AI> "), ("### System: ", "### Instruction: ", "### Response: "), ("[SYS] ", "Q: ", "A: "))


def transcripts(conversations: DataFrame) -> DataFrame:
    """Turns as raw transcript pieces (conv_id, seq, text, role): a marker style a conversation, every fifth later turn without marker."""
    style = F.pmod(F.xxhash64("conv_id", F.lit("style")), F.lit(len(STYLES)))
    spoken = F.lit("")
    for i, names in enumerate(STYLES):
        for role, name in zip(ROLES, names):
            spoken = F.when((style == i) & (F.col("role") == role), name).otherwise(spoken)
    bare = (F.pmod(F.xxhash64("conv_id", "turn", F.lit("bare")), F.lit(5)) == 0) & (F.col("turn") > 0)
    return conversations.select("conv_id", F.col("turn").cast("long").alias("seq"), F.when(bare, F.col("text")).otherwise(F.concat(spoken, "text")).alias("text"), "role")


def held_out(conv: Column) -> Column:
    return F.pmod(F.xxhash64(conv, F.lit("fold")), F.lit(2)) == 1


def recovered_turns(conversations: DataFrame) -> DataFrame:
    """Parse the table's transcripts with a model of the conversations that aren't held out."""
    pieces = transcripts(conversations)
    model = fit(pieces.where(~held_out(F.col("conv_id"))))
    found = turns(decode(pieces.drop("role"), model))
    return found.select(F.col("conv").cast("long").alias("conv_id"), "seq", "line_no", "role", "n_lines", "rendered")
