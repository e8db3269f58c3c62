"""Transaction resolution over an event log, by ranges of arrival order.

The log has seq, transactional_id, kind (INIT, ADD, MSG, END), topic, value, claimed_pid,
claimed_epoch and is_commit. What a range of seq does to an id is summed up in one row (INITs in
it, the last producer, whether a transaction is left open, its first terminal); rows see the
ranges before or behind theirs through such rows alone. So the rows of one id are spread over as
many tasks as it has ranges, and no window holds more than RANGE of them. The log is read
twice: once without topics and values, once for its messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.session import materialise

#: Epochs of a producer id; the next INIT takes a new id.
EPOCHS = 32768
#: Arrival numbers of a range.
RANGE = 1 << 16
_KEY = ["transactional_id", "part"]


def _part(seq: str = "seq") -> Column:
    return F.floor(F.col(seq) / F.lit(RANGE))


def _before(order: str | Column):
    """The rows of an id and range that come before the current one in this order."""
    return Window.partitionBy(*_KEY).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _ranges(order: str | Column = "part"):
    """The ranges of an id that come before the current one in this order."""
    return Window.partitionBy("transactional_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def running_total(df: DataFrame, key: str, value: str) -> DataFrame:
    """df (key, value) with `before`, the sum of the values of smaller keys: within blocks of keys, then over blocks."""
    blocks = df.withColumn("block", F.floor(F.col(key) / F.lit(4096)))
    sums = blocks.groupBy("block").agg(F.sum(value).alias("total"))
    # One row for each 4,096 keys.
    sums = sums.select("block", (F.sum("total").over(Window.orderBy("block")) - F.col("total")).alias("ahead"))
    within = F.sum(value).over(Window.partitionBy("block").orderBy(key)) - F.col(value)
    return blocks.withColumn("within", within).join(sums, "block").withColumn("before", F.col("ahead") + F.col("within")).drop("block", "within", "ahead")


def control(log: DataFrame) -> DataFrame:
    """The log's rows but its messages, of which one row (without seq) tells the ids and ranges that have any. Written once."""
    own = F.col("kind") != "MSG"
    claims = [F.lit(None).cast(t).alias(c) if c not in log.columns else F.when(own, F.col(c).cast(t)).alias(c) for c, t in (("claimed_pid", "long"), ("claimed_epoch", "int"), ("is_commit", "boolean"))]
    rows = log.where(own | F.col("transactional_id").isNotNull()).select("transactional_id", _part().alias("part"), "kind", F.when(own, F.col("seq")).alias("seq"), *claims)
    return materialise(rows.distinct(), "control")


def _sessions(rows: DataFrame) -> DataFrame:
    """Rows (seq, transactional_id, part, pid, epoch) for each INIT of a written control table."""
    inits = rows.where("kind = 'INIT' AND transactional_id IS NOT NULL").select("seq", *_KEY)
    sums = inits.groupBy(*_KEY).agg(F.count("*").alias("n"))
    sums = sums.select(*_KEY, F.coalesce(F.sum("n").over(_ranges()), F.lit(0)).alias("earlier"))
    k = F.row_number().over(Window.partitionBy(*_KEY).orderBy("seq"))
    n = F.col("earlier") + F.col("k") - 1
    known = inits.withColumn("k", k).join(sums, _KEY).select("seq", *_KEY, (n % EPOCHS).cast("int").alias("epoch"), F.floor(n / EPOCHS).alias("turn"))
    # INITs without an id each take a producer id from the same counter.
    plain = rows.where("kind = 'INIT' AND transactional_id IS NULL").select("seq", *_KEY, F.lit(0).alias("epoch"), F.lit(0).cast("long").alias("turn"))
    counted = materialise(known.unionByName(plain), "inits")
    taking = counted.where("epoch = 0")
    offsets = running_total(taking.groupBy("part").agg(F.count("*").alias("size")), "part", "size")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("seq"))
    taken = taking.withColumn("k", rank).join(offsets.select("part", "before"), "part").select("seq", *_KEY, "turn", (F.col("before") + F.col("k")).cast("long").alias("pid"))
    taken = materialise(taken, "taken")
    of_id = counted.where("transactional_id IS NOT NULL").join(taken.drop("seq", "part"), ["transactional_id", "turn"])
    alone = taken.where("transactional_id IS NULL").select("seq", *_KEY, "pid", F.lit(0).alias("epoch"))
    return of_id.select("seq", *_KEY, "pid", "epoch").unionByName(alone)


def producer_sessions(log: DataFrame) -> DataFrame:
    """(seq, transactional_id, pid, epoch) for each INIT.

    The first INIT of an id takes the next producer id and epoch 0, each later one the next
    epoch; past the last epoch it takes a new producer id. INITs without an id each take one.
    Producer ids count from 1 in order of seq over all of them.
    """
    return _sessions(control(log.where("kind = 'INIT'"))).select("seq", "transactional_id", "pid", "epoch")


def resolve(log: DataFrame) -> DataFrame:
    """The log's control rows (seq, transactional_id, part, kind, is_commit) with valid, zombie and terminal.

    valid: for ADD and END, whether they name the producer of the last INIT. zombie: an INIT
    that meets an open transaction. terminal: COMMIT or ABORT where a transaction ends. Rows
    without an id have no producer. A row of kind MSG and without seq stands for each id and
    range that have messages.
    """
    rows = control(log)
    sessions = _sessions(rows).where("transactional_id IS NOT NULL").select("transactional_id", "seq", F.struct("pid", "epoch").alias("producer"))
    known = rows.where("transactional_id IS NOT NULL").join(sessions, ["transactional_id", "seq"], "left")
    # The producer of an ADD or END: of the last INIT in its range, or else of an earlier range.
    known = materialise(known.withColumn("local", F.last("producer", True).over(_before("seq"))), "known")
    ends = known.groupBy(*_KEY).agg(F.max_by("producer", F.when(F.col("producer").isNotNull(), F.col("seq"))).alias("producer"))
    carried = ends.select(*_KEY, F.last("producer", True).over(_ranges()).alias("carried"))
    checked = known.join(carried, _KEY).withColumn("current", F.coalesce("local", "carried"))
    same = (F.col("claimed_pid") == F.col("current.pid")) & (F.col("claimed_epoch") == F.col("current.epoch"))
    checked = checked.withColumn("valid", F.when(F.col("kind").isin("ADD", "END"), F.coalesce(same, F.lit(False))))
    # INIT and a valid END close; a valid ADD opens.
    opens = F.when((F.col("kind") == "ADD") & F.col("valid"), True).when((F.col("kind") == "INIT") | ((F.col("kind") == "END") & F.col("valid")), False)
    checked = checked.withColumn("opens", opens).withColumn("was_open", F.last("opens", True).over(_before("seq")))
    checked = materialise(checked.select("seq", *_KEY, "kind", "is_commit", "valid", "opens", "was_open"), "checked")
    ends = checked.groupBy(*_KEY).agg(F.max_by("opens", F.when(F.col("opens").isNotNull(), F.col("seq"))).alias("opens"))
    carried = ends.select(*_KEY, F.last("opens", True).over(_ranges()).alias("carried"))
    done = checked.join(carried, _KEY).withColumn("zombie", (F.col("kind") == "INIT") & F.coalesce("was_open", "carried", F.lit(False)))
    ended = F.when(F.col("zombie"), "ABORT").when((F.col("kind") == "END") & F.col("valid"), F.when(F.col("is_commit"), "COMMIT").otherwise("ABORT"))
    done = done.select("seq", *_KEY, "kind", "is_commit", "valid", "zombie", ended.alias("terminal"))
    alone = rows.where("transactional_id IS NULL").select("seq", *_KEY, "kind", "is_commit", F.when(F.col("kind").isin("ADD", "END"), False).alias("valid"), F.lit(False).alias("zombie"), F.lit(None).cast("string").alias("terminal"))
    return done.unionByName(alone)


def _requests(log: DataFrame) -> DataFrame:
    """Rows that say what becomes of transactions; messages change nothing there."""
    return log.where("kind <> 'MSG'")


def fence_checks(log: DataFrame) -> DataFrame:
    """(seq, transactional_id, kind, fenced) for each ADD and END."""
    return resolve(_requests(log)).where(F.col("kind").isin("ADD", "END")).select("seq", "transactional_id", "kind", (~F.col("valid")).alias("fenced"))


def zombie_aborts(log: DataFrame) -> DataFrame:
    """(seq, transactional_id) of the INITs that abort an open transaction."""
    return resolve(_requests(log)).where("zombie").select("seq", "transactional_id")


def txn_terminals(log: DataFrame) -> DataFrame:
    """(seq, transactional_id, terminal, zombie), a row for each end of a transaction."""
    return resolve(_requests(log)).where("terminal IS NOT NULL").select("seq", "transactional_id", "terminal", "zombie")


def txn_outcomes(log: DataFrame) -> DataFrame:
    """(seq, transactional_id, topic, value, outcome, end_seq) for each MSG of a transaction: what its id's next terminal is, or OPEN."""
    end = F.when(F.col("terminal").isNotNull(), F.struct("terminal", F.col("seq").alias("end_seq")))
    ends = materialise(resolve(log).where("transactional_id IS NOT NULL AND (kind = 'MSG' OR terminal IS NOT NULL)").select("seq", *_KEY, end.alias("end")), "ends")
    first = ends.groupBy(*_KEY).agg(F.min_by("end", F.when(F.col("end").isNotNull(), F.col("seq"))).alias("end"))
    later = first.select(*_KEY, F.last("end", True).over(_ranges(F.desc("part"))).alias("later"))
    # What comes next is found from the end: a frame that only grows, so a pass is linear.
    told = log.where("kind = 'MSG' AND transactional_id IS NOT NULL").select("seq", "transactional_id", _part().alias("part"), "topic", "value")
    both = told.unionByName(ends.where("end IS NOT NULL"), allowMissingColumns=True)
    rows = both.withColumn("next", F.last("end", True).over(_before(F.desc("seq")))).where("end IS NULL")
    rows = rows.join(later, _KEY).withColumn("next", F.coalesce("next", "later"))
    return rows.select("seq", "transactional_id", "topic", "value", F.coalesce("next.terminal", F.lit("OPEN")).alias("outcome"), F.col("next.end_seq").alias("end_seq"))


def committed_messages(log: DataFrame) -> DataFrame:
    return txn_outcomes(log).where("outcome = 'COMMIT'")


def latest_commit(committed: DataFrame) -> DataFrame:
    """Of rows with path and end_seq, those of the newest commit of each path.

    The newest commits, a row for each path, are found by map-side maxima, so that a path with
    very many rows is no window.
    """
    newest = committed.groupBy("path").agg(F.max("end_seq").alias("end_seq"))
    return committed.join(newest, ["path", "end_seq"], "left_semi")
