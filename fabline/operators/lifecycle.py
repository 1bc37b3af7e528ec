"""Material lifecycle (W6), stage gates (F5) and one-time ids (W8).

Per material id, in ``(ts, seq)`` order: loaded -> forwarded (allow-list)
-> roll query answered -> rolled -> ready for the quality check (gate:
known and rolled) -> colour check classified (gate: ready) -> unload
decision (gate: quality known) -> final (the id leaves the allow-list, so a
later load is dropped). Every handled message yields one action row with
the command message it sends, if any.

Two behaviours of the line are kept: the quality station is always
answered ``id|0`` whatever the prediction (the real decision goes out at
unloading), and a failed prediction leaves the quality unset so the unload
query is never answered. Re-forwarding a known id does not reset its state.
"""

from __future__ import annotations

from collections import namedtuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabline.functions import codes as C
from fabline.operators.fold import FoldSpec, run_fold
from fabline.operators.ordered import BUCKET_ROWS, asof_last, null_safe_join, prefix_sum, row_bucket
from fabline.session import ensure_checkpoint_dir

LIFECYCLE_TOPICS = [C.LOADING_MAT_LOADED, C.LOADING_MAT_POSITION, C.ROLLING_MAT_POSITION,
                    C.QUALITY_MAT_POSITION, C.UNLOADING_MAT_POSITION, C.ROLLING_ROLL_QUERY,
                    C.ROLLING_MAT_AFTER_ROLL, C.QUALITY_MAT_READY_TO_QCHECK, C.COLOUR_MAT_CHECK,
                    C.UNLOADING_MAT_QUERY, C.UNLOADING_MAT_FINAL]

OUT_SCHEMA = "seq long, action string, out_topic string, out_payload string, quality string"


def _step(state, r):
    known, allowed, rolled, ready, quality = state
    if allowed is None:
        allowed = bool(r.allowed0)
    t, mid = r.topic, r.id
    out_t = out_p = None
    if t == C.LOADING_MAT_LOADED:
        action = "forward" if allowed else "drop"
        out_t, out_p = C.LOADING_MAT_PROCESS, f"{mid}|{'F' if allowed else 'D'}"
    elif t.endswith("/MatPosition"):
        action = "position" if known else ("ignored" if t == C.LOADING_MAT_POSITION else "unknown_material")
    elif t == C.ROLLING_ROLL_QUERY:
        action = "thickness" if known else "unknown_material"
        if known:
            out_t, out_p = C.ROLLING_ROLL_THICKNESS, f"{mid}|{r.thickness0 if allowed else 'null'}"
    elif t == C.ROLLING_MAT_AFTER_ROLL:
        action = "rolled" if known else "unknown_material"
    elif t == C.QUALITY_MAT_READY_TO_QCHECK:
        action = "ready" if (known and rolled) else "not_ready"
        if action == "ready":
            out_t, out_p = C.COLOUR_MAT_READY_TO_QCHECK, mid
    elif t == C.COLOUR_MAT_CHECK:
        action = "check_skipped" if not known else ("classified" if ready else "not_ready")
        if action == "classified":
            out_t, out_p = C.QUALITY_MAT_CHECK, f"{mid}|0"
    elif t == C.UNLOADING_MAT_QUERY:
        action = "unload" if (known and quality is not None) else "no_answer"
        if action == "unload":
            out_t, out_p = C.UNLOADING_MAT_DROP, f"{mid}|{'0' if quality == C.GOOD else '1'}"
    elif t == C.UNLOADING_MAT_FINAL:
        action = "final" if (known and quality is not None) else "final_ignored"
    else:
        action = "log"
    known = known or action == "forward"
    allowed = False if action == "final" else allowed
    rolled = rolled or action == "rolled"
    ready = ready or action == "ready"
    if action == "classified" and r.prediction is not None:
        quality = r.prediction
    return [known, allowed, rolled, ready, quality], [(r.seq, action, out_t, out_p, quality)]


LIFECYCLE_SPEC = FoldSpec(lambda: [False, None, False, False, None], _step,
                          ["seq", "id", "topic", "allowed0", "thickness0", "prediction"], OUT_SCHEMA)


def material_lifecycle_fold(msgs: DataFrame, allow: DataFrame, predictions: DataFrame | None = None,
                           id_col: str = "id") -> DataFrame:
    """Reference form of ``material_lifecycle`` as an explicit per-id state
    machine (segmented fold). Same output; used to cross-check the
    declarative form on small inputs."""
    m = _lifecycle_input(msgs, allow, predictions, id_col)
    m = m.withColumn("ts_us", F.unix_micros("ts"))
    return run_fold(m, [id_col], ["ts_us", "seq"], LIFECYCLE_SPEC)


def _messages(msgs: DataFrame, id_col: str) -> DataFrame:
    return msgs.where(F.col("topic").isin(*LIFECYCLE_TOPICS)).select(id_col, "seq", "ts", "topic")


def _thickness(allow: DataFrame, id_col: str) -> DataFrame:
    return allow.groupBy(F.col("id").alias(id_col)).agg(F.max("thickness").alias("thickness0"))


def _with_predictions(m: DataFrame, predictions: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(colour checks with their prediction, all other messages). Only checks carry one; the others stay out of the join."""
    checks = F.col("topic") == C.COLOUR_MAT_CHECK
    none = F.lit(None).cast("string")
    if predictions is None:
        return m.where(checks).withColumn("prediction", none), m.where(~checks).withColumn("prediction", none)
    joined = m.where(checks).join(predictions.select("seq", "prediction"), "seq", "left").select(*m.columns, "prediction")
    return joined, m.where(~checks).withColumn("prediction", none)


def _lifecycle_input(msgs, allow, predictions, id_col):
    checks, others = _with_predictions(_messages(msgs, id_col), predictions)
    m = checks.unionByName(others).join(_thickness(allow, id_col), id_col, "left")
    return m.withColumn("allowed0", F.col("thickness0").isNotNull())


# --- live form: allow-list as messages, state as a table ---------------------
#: Control messages of a changing allow-list: an id is allowed (payload: its thickness) or taken off.
ALLOW_TOPIC, REMOVE_TOPIC = "/control/allow", "/control/remove"
LIFE_STATE = "known boolean, allowed boolean, rolled boolean, ready boolean, quality string, thickness string"


def _live_step(state, r):
    known, allowed, rolled, ready, quality, thickness = state
    if r.topic == ALLOW_TOPIC:
        return [known, True, rolled, ready, quality, r.payload], None
    if r.topic == REMOVE_TOPIC:
        return [known, False, rolled, ready, quality, thickness], None
    message = _Message(r.seq, r.id, r.topic, allowed, thickness, r.prediction)
    after, out = _step([known, allowed, rolled, ready, quality], message)
    return [*after, thickness], out


_Message = namedtuple("Message", LIFECYCLE_SPEC.in_cols)
LIVE_SPEC = FoldSpec(lambda: [False, False, False, False, None, None], _live_step,
                     ["seq", "id", "topic", "payload", "prediction"], OUT_SCHEMA)


def lifecycle_state(allow: DataFrame, actions: DataFrame | None = None, msgs: DataFrame | None = None) -> DataFrame:
    """State of every id (``id`` and ``LIFE_STATE``) that a stream can start from.

    Without ``actions`` it is the allow-list alone; with the actions of a batch and the messages they answer (``id, seq,
    ts``) it is the state after that batch.
    """
    a = allow.where(F.col("id").isNotNull()).groupBy("id").agg(F.max("thickness").alias("thickness"))
    if actions is None:
        return a.select("id", F.lit(False).alias("known"), F.lit(True).alias("allowed"), F.lit(False).alias("rolled"),
                        F.lit(False).alias("ready"), F.lit(None).cast("string").alias("quality"), "thickness")
    s = actions.groupBy("id").agg(
        *[F.max(F.col("action") == name).alias(flag) for name, flag in
          (("forward", "known"), ("rolled", "rolled"), ("ready", "ready"), ("final", "gone"))])
    # An id's quality once set stays set, so its last one is the last of those rows.
    timed = null_safe_join(actions.where(F.col("quality").isNotNull()).select("id", "seq", "quality"), msgs.select("id", "seq", "ts"), ["id", "seq"])
    last = timed.groupBy("id").agg(F.max_by("quality", F.struct("ts", "seq")).alias("quality"))
    j = null_safe_join(s, last, ["id"], "left").join(a, "id", "full")
    off = F.coalesce("gone", F.lit(False))
    return j.select("id", F.coalesce("known", F.lit(False)).alias("known"),
                    (F.col("thickness").isNotNull() & ~off).alias("allowed"),
                    *[F.coalesce(c, F.lit(False)).alias(c) for c in ("rolled", "ready")], "quality", "thickness")


def _first_after(k: DataFrame, rows: DataFrame, id_col: str, after: str, name: str) -> DataFrame:
    """``k`` with ``name``: per id, the first ``(ts, seq)`` of ``rows`` after milestone ``after``."""
    hit = rows.join(k.select(id_col, after), id_col).where(F.col("o") > F.col(after))
    return k.join(hit.groupBy(id_col).agg(F.min("o").alias(name)), id_col, "left")


def material_lifecycle(msgs: DataFrame, allow: DataFrame, predictions: DataFrame | None = None,
                       id_col: str = "id") -> DataFrame:
    """Action rows per material message: ``id, seq, action, out_topic,
    out_payload, quality``.

    ``allow`` is ``id, thickness``; ``predictions`` is ``seq, prediction``
    for colour-check messages (missing -> the prediction failed).

    The state of a material only moves forward, so it is rebuilt from
    per-id milestones instead of a row-by-row fold: the first forward (the
    first load of an allowed id), the first roll after it, the first ready
    check after that, the first classification with a prediction after that
    and the first final after that (which takes the id off the allow-list).
    A milestone is an aggregate over the messages of its own topic (partial
    aggregation, no single task per id); one table holds those of all ids.
    All messages are shuffled once, by id, where they meet that table and
    the last classified prediction up to each of them; if an id has more
    rows than a bucket, this as-of runs per id and row bucket.
    """
    t, o = F.col("topic"), F.col("o")
    # The input feeds five aggregates and the result: written once to the
    # shared folder instead of derived per branch or held on executors.
    ensure_checkpoint_dir(msgs.sparkSession)
    m = _messages(msgs, id_col).checkpoint().withColumn("o", F.struct("ts", "seq"))
    checks, others = _with_predictions(m, predictions)
    checks = checks.checkpoint()
    k = m.groupBy(id_col).agg(F.min(F.when(t == C.LOADING_MAT_LOADED, o)).alias("first_load"), F.count(F.lit(1)).alias("n_rows"))
    k = k.join(_thickness(allow, id_col), id_col, "left").withColumn("known_from", F.when(F.col("thickness0").isNotNull(), F.col("first_load")))
    k = _first_after(k, m.where(t == C.ROLLING_MAT_AFTER_ROLL), id_col, "known_from", "rolled_from")
    k = _first_after(k, m.where(t == C.QUALITY_MAT_READY_TO_QCHECK), id_col, "rolled_from", "ready_from")
    k = _first_after(k, checks.where(F.col("prediction").isNotNull()), id_col, "ready_from", "quality_from")
    k = _first_after(k, m.where(t == C.UNLOADING_MAT_FINAL), id_col, "quality_from", "final_from").drop("first_load").checkpoint()
    split = not k.where(F.col("n_rows") > BUCKET_ROWS).isEmpty()

    r = checks.unionByName(others).join(k.drop("n_rows"), id_col, "left")
    allowed0 = F.col("thickness0").isNotNull()
    kn, rl, rd = [F.coalesce(o > F.col(c), F.lit(False)) for c in ("known_from", "rolled_from", "ready_from")]
    # Quality after each message: the last classified prediction up to it.
    # Unload queries and finals are never classifications, so for them it is
    # also the quality before the message.
    r = r.withColumn("__pred", F.when((t == C.COLOUR_MAT_CHECK) & kn & rd, F.col("prediction")))
    if split:
        r = asof_last(row_bucket(r, [id_col], rows=BUCKET_ROWS), [id_col], ["ts", "seq"], "__day", ["__pred"]).withColumnRenamed("__pred_asof", "quality")
    else:
        upto = Window.partitionBy(id_col).orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
        r = r.withColumn("quality", F.last("__pred", ignorenulls=True).over(upto))
    has_q = F.col("quality").isNotNull()
    allowed = allowed0 & (F.col("final_from").isNull() | (o <= F.col("final_from")))
    action = (
        F.when(t == C.LOADING_MAT_LOADED, F.when(allowed, "forward").otherwise("drop"))
        .when(t.endswith("/MatPosition"), F.when(kn, "position")
              .when(t == C.LOADING_MAT_POSITION, "ignored").otherwise("unknown_material"))
        .when(t == C.ROLLING_ROLL_QUERY, F.when(kn, "thickness").otherwise("unknown_material"))
        .when(t == C.ROLLING_MAT_AFTER_ROLL, F.when(kn, "rolled").otherwise("unknown_material"))
        .when(t == C.QUALITY_MAT_READY_TO_QCHECK, F.when(kn & rl, "ready").otherwise("not_ready"))
        .when(t == C.COLOUR_MAT_CHECK, F.when(~kn, "check_skipped").when(rd, "classified").otherwise("not_ready"))
        .when(t == C.UNLOADING_MAT_QUERY, F.when(kn & has_q, "unload").otherwise("no_answer"))
        .when(t == C.UNLOADING_MAT_FINAL, F.when(kn & has_q, "final").otherwise("final_ignored"))
        .otherwise("log"))
    r = r.withColumn("action", action)
    a, mid = F.col("action"), F.col(id_col)
    out_t = (F.when(a.isin("forward", "drop"), F.lit(C.LOADING_MAT_PROCESS))
             .when(a == "thickness", F.lit(C.ROLLING_ROLL_THICKNESS))
             .when(a == "ready", F.lit(C.COLOUR_MAT_READY_TO_QCHECK))
             .when(a == "classified", F.lit(C.QUALITY_MAT_CHECK))
             .when(a == "unload", F.lit(C.UNLOADING_MAT_DROP)))
    out_p = (F.when(a == "forward", F.concat(mid, F.lit("|F")))
             .when(a == "drop", F.concat(mid, F.lit("|D")))
             .when(a == "thickness", F.concat(mid, F.lit("|"),
                                              F.when(allowed, F.col("thickness0")).otherwise(F.lit("null"))))
             .when(a == "ready", mid)
             .when(a == "classified", F.concat(mid, F.lit("|0")))
             .when(a == "unload", F.concat(mid, F.when(F.col("quality") == C.GOOD, F.lit("|0"))
                                           .otherwise(F.lit("|1")))))
    return r.select(id_col, "seq", "action", out_t.alias("out_topic"), out_p.alias("out_payload"), "quality")


# --- F5 ---------------------------------------------------------------------
GATES = {"ready": True, "not_ready": False, "classified": True, "check_skipped": False,
         "unload": True, "no_answer": False}


def stage_gate(actions: DataFrame) -> DataFrame:
    """Gate outcomes of the lifecycle: ``id, seq, gate, passed``."""
    g = actions.where(F.col("action").isin(*GATES))
    passed = F.col("action").isin(*[a for a, ok in GATES.items() if ok])
    return g.select("id", "seq", "action", passed.alias("passed"))


# --- W8 ---------------------------------------------------------------------
def one_time_id(msgs: DataFrame, allow: DataFrame, id_col: str = "id") -> DataFrame:
    """Loads with their decision when each final event removes the id from
    the allow-list: ``F`` only if allowed and no final came before."""
    m = msgs.where(F.col("topic").isin(C.LOADING_MAT_LOADED, C.UNLOADING_MAT_FINAL))
    m = row_bucket(m, [id_col])
    c = prefix_sum(m, [id_col], ["ts", "seq"], "__day",
                   {"n_final_before": (F.col("topic") == C.UNLOADING_MAT_FINAL).cast("int")},
                   inclusive=False).drop("__day")
    loads = c.where(F.col("topic") == C.LOADING_MAT_LOADED)
    a = allow.select(F.col("id").alias(id_col), F.lit(True).alias("__allowed")).dropDuplicates([id_col])
    j = loads.join(a, id_col, "left")
    dec = F.when(F.coalesce(F.col("__allowed"), F.lit(False)) & (F.col("n_final_before") == 0), "F").otherwise("D")
    return j.withColumn("decision", dec).drop("__allowed")
