"""Operator 6, chat formatting: roles of transcript lines by a hidden Markov
model, then canonical turns.

The unit is the line: every text is cut into its lines, whether it is one turn
or a whole transcript.  A hidden state says whose line it is and whether it
begins what the speaker says or goes on with it; a line shows whether it has a
speaker marker, is the first of its text, its length and a question mark.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.merkle import placed
from tidewatch.llm.text import space_words

ROLES = ("system", "user", "assistant")
# Fixed speaker markers, by role.
MARKERS = {
    "system": ("system", "instruction", "instructions"),
    "user": ("user", "human", "customer", "question", "q", "me"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "model"),
}
CHUNK = 512          # lines decoded together; longer conversations are cut and rejoined exactly
LENGTH_BUCKETS = 10
FEATURES = {"marker": len(ROLES) + 1, "length": LENGTH_BUCKETS, "question": 2, "first": 2}
STATES = 2 * len(ROLES)   # state 2 * role: the line begins a turn; 2 * role + 1: it goes on
SMOOTH = 0.05             # weight of even shares in every table, so rare states are not smoothed more
# What a line shows, before any data is seen; half the weight of the model's
# tables.  A beginning line has its role's marker, none, or another's; a line
# that goes on has none, and is not the first of its text.
OWN_MARKER, NO_MARKER, OTHER_MARKER, STRAY = 0.499998, 0.5, 1e-6, 1e-8
FIRST = 0.7


@dataclass(frozen=True)
class Model:
    """Log probabilities: start[state], step[state, state], emit[feature][state, value]."""
    start: np.ndarray
    step: np.ndarray
    emit: dict


def _marker_pattern(words) -> str:
    return r"^\s*[#*<|\[(]{0,4}\s*(?i:" + "|".join(words) + r")\s*[\])|>*]{0,4}\s*[:>]"


def transcript_lines(transcripts: DataFrame, id_col: str = "conv_id", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, text): the lines of raw transcripts, numbered as turns;
    blank lines go.  (``decode`` cuts texts into lines by itself.)"""
    lines = transcripts.select(F.col(id_col).alias("conv_id"), F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("turn", "text"))
    return lines.where(r"text rlike '[^\\x20\\x09-\\x0D]'").withColumn("turn", F.col("turn").cast("bigint"))


def row_lines(rows: DataFrame, *more: str) -> DataFrame:
    """conv_id, turn, ``more``, row (64-bit hash of the whole text), line (from 0),
    n_lines, text: the lines of every text that are not blank, an empty one
    where there is none."""
    cut = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    lines = F.when(F.size(cut) > 0, cut).otherwise(F.array(F.lit("")))
    d = rows.select("conv_id", "turn", *more, F.xxhash64("text").alias("row"), lines.alias("_l"))
    d = d.withColumn("n_lines", F.size("_l"))
    return d.select("conv_id", "turn", *more, "row", "n_lines", F.posexplode("_l").alias("line", "text"))


def with_features(lines: DataFrame) -> DataFrame:
    """Adds marker, length, question and first (int) to ``row_lines``."""
    text = F.col("text")
    marker = F.lit(len(ROLES))
    for i, r in reversed(list(enumerate(ROLES))):
        marker = F.when(text.rlike(_marker_pattern(MARKERS[r])), i).otherwise(marker)
    words = F.size(space_words(text))
    return lines.withColumns({
        "marker": marker,
        "length": F.least(F.floor(F.log2(words + 1.0)), F.lit(LENGTH_BUCKETS - 1)).cast("int"),
        "question": text.rlike(r"[?\x{FF1F}]\s*$").cast("int"),
        "first": (F.col("line") == 0).cast("int"),
    })


def fit(labelled: DataFrame) -> Model:
    """Start, step and emission probabilities counted over all labelled rows
    (conv_id, turn, text, role).

    Only count tables of fixed size reach the driver.  Steps between texts are
    counted by a join of every turn with the next number, so a conversation of
    any length spreads over all tasks.  Rows without a known role are ignored.
    """
    n = len(ROLES)
    rows = labelled.select("conv_id", "turn", "text", "role").where(F.col("role").isin(*ROLES))
    lines = with_features(row_lines(rows, "role"))
    emit = {name: np.zeros((STATES, size)) for name, size in FEATURES.items()}
    for r in lines.groupBy("role", *FEATURES).count().collect():
        state = 2 * ROLES.index(r.role) + 1 - r["first"]
        for name in FEATURES:
            emit[name][state, r[name]] += r["count"]
    step, may = np.zeros((STATES, STATES)), np.zeros((STATES, STATES), dtype=bool)
    may[:, ::2] = True
    for i in range(n):
        may[[2 * i, 2 * i + 1], 2 * i + 1] = True     # only its own speaker goes on
    whole = lines.where("first = 1")                  # one line stands for its text
    for r in whole.groupBy("role").agg(F.count(F.when(F.col("n_lines") > 1, 1)).alias("on"), F.sum(F.greatest(F.col("n_lines") - 2, F.lit(0))).alias("more")).collect():
        i = 2 * ROLES.index(r.role)
        step[i, i + 1] += r.on
        step[i + 1, i + 1] += r.more
    here = whole.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"), (F.col("n_lines") > 1).cast("int").alias("went_on"))
    for r in here.join(whole.select("conv_id", "turn", "role"), ["conv_id", "turn"]).groupBy("before", "went_on", "role").count().collect():
        step[2 * ROLES.index(r.before) + r.went_on, 2 * ROLES.index(r.role)] += r["count"]
    start = np.zeros((1, STATES))
    first = whole.groupBy("conv_id").agg(F.min_by("role", F.struct("turn", "row")).alias("role"))
    for r in first.groupBy("role").count().collect():
        start[0, 2 * ROLES.index(r.role)] += r["count"]

    def smoothed(counts, allowed=None):
        """Rows of shares; a state without data has even ones."""
        even = np.ones_like(counts) if allowed is None else allowed.astype(float)
        even /= even.sum(axis=1, keepdims=True)
        total = counts.sum(axis=1, keepdims=True)
        return np.where(total > 0, (1 - SMOOTH) * counts / np.maximum(total, 1) + SMOOTH * even, even)

    shares = {k: smoothed(v) for k, v in emit.items() if k not in ("marker", "first")}
    shares |= {k: emit[k] / np.maximum(emit[k].sum(axis=1, keepdims=True), 1) for k in ("marker", "first")}
    marker = np.full((STATES, n + 1), OTHER_MARKER)
    marker[::2, n] = NO_MARKER
    marker[2 * np.arange(n), np.arange(n)] = OWN_MARKER
    marker[1::2] = STRAY
    marker[1::2, n] = 1 - n * STRAY
    prior = {"marker": marker, "first": np.array([[1 - FIRST, FIRST], [1 - STRAY, STRAY]] * n)}
    for k, even in prior.items():
        shares[k] = np.where(emit[k].sum(axis=1, keepdims=True) > 0, (shares[k] + even) / 2, even)
    with np.errstate(divide="ignore"):
        return Model(np.log(smoothed(start, np.arange(STATES)[None] % 2 == 0))[0], np.log(smoothed(step, may)), {k: np.log(v) for k, v in shares.items()})


def _emissions(model: Model, part: dict) -> np.ndarray:
    return sum(model.emit[f][:, part[f]].T for f in FEATURES)


def _viterbi(model: Model, emit: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best score to end in each state, and the back pointers; ``begin`` is
    the score of each state before the first emission."""
    back = np.zeros((len(emit), STATES), dtype=np.int8)
    score = begin + emit[0]
    for t in range(1, len(emit)):
        options = score[:, None] + model.step
        back[t] = options.argmax(axis=0)
        score = options.max(axis=0) + emit[t]
    return score, back


def _trace(back: np.ndarray, last: int) -> np.ndarray:
    path = np.empty(len(back), dtype=np.int64)
    for t in range(len(back) - 1, -1, -1):
        path[t] = last
        last = back[t][last]
    return path


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict]:
    """Runs of equal keys of sorted rows, as arrays by column; a run may go on
    over batches."""
    held = None
    for b in batches:
        b = b if held is None else pd.concat([held, b], ignore_index=True)
        if not len(b):
            continue
        new = np.zeros(len(b) - 1, dtype=bool)
        for k in keys:
            v, gone = b[k], b[k].isna().to_numpy()
            new |= (v.to_numpy()[1:] != v.to_numpy()[:-1]) & ~(gone[1:] & gone[:-1])
        cuts = np.nonzero(new)[0] + 1
        cols = {c: b[c].to_numpy() for c in b.columns}
        for at, end in zip(np.concatenate([[0], cuts[:-1]]), cuts) if len(cuts) else ():
            yield {c: v[at:end] for c, v in cols.items()}
        held = b.iloc[cuts[-1]:] if len(cuts) else b
    if held is not None and len(held):
        yield {c: held[c].to_numpy() for c in held.columns}


def _frames(rows: Iterator[dict], every: int = 2_000) -> Iterator[pd.DataFrame]:
    """Column arrays joined to one frame per ``every`` groups."""
    held = []
    for r in rows:
        held.append(r)
        if len(held) == every:
            yield pd.DataFrame({c: np.concatenate([h[c] for h in held]) for c in held[0]})
            held = []
    if held:
        yield pd.DataFrame({c: np.concatenate([h[c] for h in held]) for c in held[0]})


def decode(rows: DataFrame, model: Model) -> DataFrame:
    """(conv_id, turn, line, text, role, new_turn): the most likely speaker of
    every line that is not blank (``line`` counts them from 0 in their text; a
    text without any has one empty line).  ``new_turn``: the speaker changes or
    the line has a marker.

    Exact Viterbi in three steps, so one conversation may be of any length:
    every CHUNK consecutive lines yield the best score between each pair of
    first and last state; the chunks of a conversation are joined by the same
    recursion over these tables (one small row per chunk); every chunk is then
    decoded between its settled ends.  Lines are numbered by a range sort, so
    neither null conv_ids (they form one conversation) nor null or repeated
    turns (null first; equal turns by the hash of their text) make a large
    chunk.  Identical rows count once.  Ties go to the state that comes first.
    An empty table gives an empty result.
    """
    kind, turn_kind = dict(rows.dtypes)["conv_id"], dict(rows.dtypes)["turn"]
    lines = with_features(row_lines(rows.select("conv_id", "turn", "text").distinct()))
    keyed = lines.withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))).checkpoint()
    turns = placed(keyed, "conv", ["turn", "row", "line"]).withColumn("chunk", F.floor(F.col("pos") / CHUNK)).drop("count")
    n = STATES
    pairs = [f"m{i}_{j}" for i in range(n) for j in range(n)]

    def chunk_tables(batches):
        for g in _groups(batches, ["conv", "chunk"]):
            emit, out = _emissions(model, g), {}
            for i in range(n):
                begin = np.full(n, -np.inf)
                begin[i] = 0.0
                score, _ = _viterbi(model, emit, begin)
                out |= {f"m{i}_{j}": score[j:j + 1] for j in range(n)}
            yield {"conv": g["conv"][:1], "chunk": g["chunk"][:1]} | out

    def chunk_ends(batches):
        for g in _groups(batches, ["conv"]):
            m = np.stack([g[p] for p in pairs], axis=1).reshape(-1, n, n)
            back, score = [], None
            for t in range(len(m)):
                # entry[i]: best score before the chunk if it is entered in state i
                entry = model.start if t == 0 else (score[:, None] + model.step).max(axis=0)
                came = None if t == 0 else (score[:, None] + model.step).argmax(axis=0)
                through = entry[:, None] + m[t]
                back.append((through.argmax(axis=0), came))
                score = through.max(axis=0)
            last, out = int(score.argmax()), []
            for t in range(len(m) - 1, -1, -1):
                enter = int(back[t][0][last])
                before = -1 if t == 0 else int(back[t][1][enter])
                out.append((enter, last, before))
                last = before
            out = np.array(out[::-1])
            yield {"conv": g["conv"], "chunk": g["chunk"], "enter": out[:, 0], "leave": out[:, 1], "before": out[:, 2]}

    def line_roles(batches):
        for g in _groups(batches, ["conv", "chunk"]):
            begin = np.full(n, -np.inf)
            begin[g["enter"][0]] = 0.0
            _, back = _viterbi(model, _emissions(model, g), begin)
            path = _trace(back, int(g["leave"][0]))
            role = path // 2
            prev = np.concatenate([g["before"][:1] // 2, role[:-1]])
            yield {"conv_id": g["conv_id"], "turn": g["turn"], "line": g["line"], "pos": g["pos"], "text": g["text"],
                   "role": np.array(ROLES, dtype=object)[role], "new_turn": (role != prev) | (g["marker"] < len(ROLES))}

    def tables(batches):
        return _frames(chunk_tables(batches))

    def ends(batches):
        return _frames(chunk_ends(batches))

    def roles(batches):
        return _frames(line_roles(batches))

    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(df, *keys):
        # A stated width: the work per byte is high, so small partitions aren't merged.
        return df.repartition(width, *[F.col(k) for k in keys])

    chunks = (dealt(turns.select("conv", "chunk", "pos", *FEATURES), "conv", "chunk").sortWithinPartitions("conv", "chunk", "pos")
              .mapInPandas(tables, "conv string, chunk bigint, " + ", ".join(f"{p} double" for p in pairs)))
    settled = dealt(chunks, "conv").sortWithinPartitions("conv", "chunk").mapInPandas(ends, "conv string, chunk bigint, enter int, leave int, before int")
    full = turns.join(settled, ["conv", "chunk"])
    return dealt(full, "conv", "chunk").sortWithinPartitions("conv", "chunk", "pos").mapInPandas(
        roles, f"conv_id {kind}, turn {turn_kind}, line int, pos bigint, text string, role string, new_turn boolean")


def render(decoded: DataFrame) -> DataFrame:
    """Adds ``rendered``: the line without its speaker marker, behind a role
    header where a turn begins.  Joined in turn order the pieces of a
    conversation are its canonical transcript."""
    every = "|".join(w for ws in MARKERS.values() for w in ws)
    body = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), _marker_pattern([every]), ""))
    return decoded.withColumn("rendered", F.concat(F.when(F.col("new_turn"), F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))).otherwise(F.lit("")), body, F.lit("\n")))


def chat_report(conversations: DataFrame) -> DataFrame:
    """Roles and canonical lines of every text; ``pos`` orders the lines of a
    conversation.  The model is fitted on the conversations whose crc32(conv_id
    as text) mod 5 is not 0; the others are marked held_out."""
    held = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit(""))) % 5 == 0
    model = fit(conversations.where(~held))
    return render(decode(conversations, model)).select("conv_id", "turn", "line", "pos", "role", "new_turn", "rendered", held.alias("held_out"))
