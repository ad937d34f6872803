"""Left alignment of indels against a reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import alleles as A
from ..sources.text import CHUNK, ref_slice

#: Bases before a call that the first round looks at; each further round looks at eight times as many.
FIRST_WINDOW = 64


def _stored(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut, where the session has a checkpoint folder."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.persist()


def left_align(v: DataFrame, chunks: DataFrame, chunk: int = CHUNK, window: int = FIRST_WINDOW) -> DataFrame:
    """``v`` (unique ``vid``; ctg, pos, end, ref, alt array) with its indels moved as far to the left as the reference allows.

    Rows lose what all their alleles share at the ends, but for one base. Where one allele
    is then only that base, the others move together, as long as the last base of each
    equals the one before them: a row of several ALTs stops with the first that stops.
    Rows with a symbolic ALT and substitutions keep their place. Rounds look at wider
    windows for the rows that used up the last one, until none is left. ``v`` is read once.
    """
    alleles = F.concat(F.array("ref"), "alt")
    plain = (F.size("alt") > 0) & ~F.exists(alleles, lambda a: F.coalesce(a.rlike("[^ACGTNacgtn]") | (a == ""), F.lit(True)))
    shortest = lambda c: F.array_min(F.transform(c, lambda a: F.length(a)))
    # each select ends in a generator, so what is worked out is not worked out again by the next
    rows = v.select("*", F.explode(F.array(F.when(F.coalesce(plain, F.lit(False)), alleles))).alias("__al"))
    suffix = F.aggregate("__al", shortest("__al"), lambda n, a: A.common_suffix(F.get("__al", F.lit(0)), a, n))
    rows = rows.select("*", F.explode(F.array(suffix)).alias("__k"))
    whole = F.coalesce((F.col("__k") == shortest("__al")) & (F.col("pos") > 0), F.lit(False))
    cut = F.when(whole, F.col("__k")).otherwise(F.least(F.col("__k"), shortest("__al") - 1))
    rows = rows.select("*", whole.alias("__whole"), F.explode(F.array(F.transform("__al", lambda a: F.substring(a, F.lit(1), F.length(a) - cut)))).alias("__t"))
    prefix = F.aggregate("__t", shortest("__t"), lambda n, a: A.common_suffix(F.reverse(F.get("__t", F.lit(0))), F.reverse(a), n))
    rows = rows.select("*", F.explode(F.array(F.when(F.col("__whole"), 0).otherwise(prefix))).alias("__p"))
    anchored = (F.col("__p") == shortest("__t")) & ~F.col("__whole")
    front = F.when(anchored, F.col("__p") - 1).otherwise(F.col("__p"))
    rows = rows.select("*", anchored.alias("__anchored"), F.explode(F.array(front)).alias("__f"))
    moving = F.transform("__t", lambda a: F.substring(a, F.col("__f") + F.when(F.col("__whole"), 1).otherwise(2), F.length(a)))
    rows = rows.select("*", F.explode(F.array(F.when(F.col("__whole") | F.col("__anchored"), moving))).alias("__x"))
    indel = F.coalesce(F.exists("__x", lambda x: x == "") & F.exists("__x", lambda x: x != ""), F.lit(False))
    rows = _stored(rows.withColumn("__indel", indel))
    state = rows.where("__indel").select("vid", "ctg", (F.col("pos") + F.when(F.col("__whole"), -1).otherwise(F.col("__f"))).alias("at"), F.col("__x").alias("s"), F.lit(True).alias("open"))

    def steps(c, x):
        """Bases that one allele could move; no limit for an empty one."""
        both = F.concat(c, x)
        return F.when(x == "", F.length(c) - 1).otherwise(A.common_suffix(both, F.substring(both, F.lit(1), F.length(c)), F.length(c) - 1))

    while True:
        begin = F.greatest(F.col("at") - window, F.lit(0))
        near = ref_slice(state.where("open").withColumns({"start": begin, "end": F.col("at") + 1}), chunks, "vid", chunk, "c")
        k = F.array_min(F.transform("s", lambda x: steps(F.col("c"), x)))
        near = near.select("vid", "ctg", "at", "s", "start", "c", F.length("c").alias("n"), F.explode(F.array(F.greatest(k, F.lit(0)))).alias("k"))
        turned = F.transform("s", lambda x: F.substring(F.concat("c", x), F.col("n") - F.col("k") + 1, F.length(x)))
        moved = near.select("vid", "ctg", (F.col("at") - F.col("k")).alias("at"), F.when(F.col("n") > 0, turned).otherwise(F.col("s")).alias("s"), ((F.col("k") > 0) & (F.col("k") == F.col("n") - 1) & (F.col("start") > 0)).alias("open"))
        state = moved.unionByName(state.where("not open"))
        state = _stored(state)
        if state.where("open").isEmpty():
            break
        window *= 8
    anchors = ref_slice(state.select("vid", "ctg", "s", F.col("at").alias("start"), (F.col("at") + 1).alias("end")), chunks, "vid", chunk, "b").select("vid", F.col("start").alias("__at"), F.col("s").alias("__new"), F.col("b").alias("__b"))
    done = rows.join(anchors, "vid", "left")
    ok = F.col("__b").isNotNull() & (F.col("__b") != "")
    stays = F.col("__al").isNull() | F.col("__whole")
    trimmed = F.transform("__t", lambda a: F.substring(a, F.col("__f") + 1, F.length(a)))
    found = F.when(ok, F.transform("__new", lambda x: F.concat("__b", x))).when(stays, alleles).otherwise(trimmed)
    done = done.select("*", F.when(ok, F.col("__at")).when(stays, F.col("pos")).otherwise(F.col("pos") + F.col("__f")).alias("__pos"), F.explode(F.array(found)).alias("__found"))
    ref = F.get("__found", F.lit(0))
    new = {"pos": F.col("__pos"), "ref": ref, "alt": F.slice("__found", 2, F.greatest(F.size("__found") - 1, F.lit(0))), "end": F.col("__pos") + F.length(ref)}
    return done.select(*[new[c].alias(c) if c in new else F.col(c) for c in v.columns])
