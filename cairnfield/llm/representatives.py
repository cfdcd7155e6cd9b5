"""Best representative of each duplicate group, field by field.

Two policies serve one operator. `truths` is the latent two-sided quality model: every class of source has a sensitivity
(it states a value that is true) and a specificity (it doesn't state one that is false); expectation-maximisation infers
both with the probability of every stated value, and a field keeps every value judged true. Values that several rows of
one class state count once. What is stated by whom is first counted as patterns, so an iteration costs no more than the
distinct patterns; up to `PATTERNS` of them are iterated on the driver, more on the cluster.

`survivors` states a fixed order of trust instead: of the records whose value is usable, the one of highest usable
accuracy, then of latest update, then of smallest id. It is what the query p2_found asks for, which no inferred quality
can replace; `agreement` counts how far the two go together. Both are aggregations with map-side combination, so a group of any size stays within memory.

Cases: deleted records and those of null group take no part, nor do groups of one record. Nulls, blanks and unusable
values are no values; a field without any has no row. Ties fall to the smallest id. Repeated rows count once. Empty
tables give no rows. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnfield.llm.addresses import DIRECTION_OF, SUBLOCATIONS, parse_line
from cairnfield.session import cut

PATTERNS, ROUNDS = 200_000, 30
_NUMBER = r"^\s*\d+[a-z]?[\s,]+"
_DIRECTIONS = rf"^((?:{'|'.join(sorted(DIRECTION_OF, key=len, reverse=True))}|n\.e\.|n\.w\.|s\.e\.|s\.w\.)\.?(?:\s+|$))+"
_PARTS = rf"^(?:{SUBLOCATIONS.replace(' ', '|')})\b"
_NAMED = r"^(?:\d+(?:st|nd|rd|th)\s+[a-z]|[a-z]{2,}|\d+(?:st|nd|rd|th)\s*$)"
_BOX = r"^\s*(?:p\.?\s*o\.?\s*|post\s+office\s+)(?:box|bx)\s*#?\s*\d+"


def usable_street(c: Column) -> Column:
    """Whether a street gives a house number and a street name, or a post-office box with its number."""
    low = F.lower(c)
    rest = F.regexp_replace(F.regexp_replace(low, _NUMBER, ""), _DIRECTIONS, "")
    return F.coalesce(low.rlike(_BOX) | (low.rlike(_NUMBER) & rest.rlike(_NAMED) & ~rest.rlike(_PARTS)), F.lit(False))


def usable_accuracy(c: Column) -> Column:
    """Whether an accuracy is a number from 0 to 1."""
    return F.coalesce(c.between(0, 1) & ~F.isnan(c), F.lit(False))


def live_records(df: DataFrame, zips: DataFrame) -> DataFrame:
    """The distinct live records of groups of two or more, with the usable values of their fields, null where unusable."""
    listed = zips.select(F.col("ZIP5").alias("OPS_ZIP5"), F.col("STATE").alias("OPS_STATE"), F.lit(True).alias("listed")).distinct()
    rows = df.where("DELETED_AT is null and DUP_GROUP_ID is not null").select("ID", "DUP_GROUP_ID", "OPS_STREET", "OPS_ZIP5", "OPS_STATE", "GEOCODE_ACCURACY", "GEOCODE_LEVEL", "UPDATED_AT")
    several = rows.groupBy("DUP_GROUP_ID").agg(F.min("ID").alias("a"), F.max("ID").alias("b")).where("a <> b").select("DUP_GROUP_ID")
    rows = rows.join(several, "DUP_GROUP_ID", "left_semi").join(listed, ["OPS_ZIP5", "OPS_STATE"], "left")
    keep = lambda ok, c: F.when(ok, F.col(c)).alias(c)
    return rows.select(
        F.col("DUP_GROUP_ID").alias("dup_group_id"), "ID", "UPDATED_AT", "GEOCODE_LEVEL", keep(usable_street(F.col("OPS_STREET")), "OPS_STREET"), keep(F.col("listed"), "OPS_ZIP5"), keep(usable_accuracy(F.col("GEOCODE_ACCURACY")), "GEOCODE_ACCURACY")
    )


FIELDS = ("OPS_STREET", "OPS_ZIP5", "GEOCODE_ACCURACY")


def survivors(records: DataFrame) -> DataFrame:
    """(dup_group_id, field_name, record_id): the record that supplies each field, by the fixed order of trust."""
    trust = F.struct(
        F.col("GEOCODE_ACCURACY").isNull().alias("no_accuracy"), (-F.col("GEOCODE_ACCURACY")).alias("accuracy"), F.col("UPDATED_AT").isNull().alias("no_update"), (-F.unix_micros(F.col("UPDATED_AT").cast("timestamp"))).alias("update"), F.col("ID").alias("id")
    )
    best = records.groupBy("dup_group_id").agg(*[F.min(F.when(F.col(f).isNotNull(), trust))["id"].alias(f) for f in FIELDS])
    return best.unpivot("dup_group_id", list(FIELDS), "field_name", "record_id").where("record_id is not null")


def _street_forms(df: DataFrame) -> DataFrame:
    """The rows with `value` of a street in one form, so that spellings of one street are one value."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            forms = [" ".join(x for x in (a.number, a.direction, a.name, a.suffix) if x).upper() for a in map(parse_line, pdf["value"])]
            yield pdf.assign(value=forms)

    return df.mapInPandas(work, df.schema)


def claims(records: DataFrame) -> DataFrame:
    """(dup_group_id, field_name, value, source): what each class of source states, distinct. The table names no source, so a
    class is what tells how a record came about: the level of its geocode, the tenth of its accuracy and the year of its
    update. Values compete as they are, streets in one form of writing."""
    tenth = F.coalesce(F.least(F.floor(F.col("GEOCODE_ACCURACY") * 10), F.lit(9)).cast("string"), F.lit("none"))
    source = F.concat_ws(" ", F.coalesce("GEOCODE_LEVEL", F.lit("none")), tenth, F.coalesce(F.year("UPDATED_AT").cast("string"), F.lit("none"))).alias("source")
    one = lambda f, v: records.where(f"{f} is not null").select("dup_group_id", F.lit(f).alias("field_name"), v.alias("value"), source)
    streets = _street_forms(one("OPS_STREET", F.col("OPS_STREET")).distinct())
    return streets.unionByName(one("OPS_ZIP5", F.col("OPS_ZIP5"))).unionByName(one("GEOCODE_ACCURACY", F.col("GEOCODE_ACCURACY").cast("string"))).distinct()


def _likelihood(patterns: pd.DataFrame, quality: dict[tuple[str, str], tuple[float, float]], prior: dict[str, float]) -> np.ndarray:
    """The probability that each pattern's values are true."""
    out = []
    for field, pattern in zip(patterns["field_name"], patterns["pattern"], strict=True):
        z = np.log(prior[field] / (1 - prior[field]))
        for entry in pattern.split("\t"):
            sensitivity, false_rate = quality[field, entry[1:]]
            z += np.log(sensitivity / false_rate) if entry[0] == "+" else np.log((1 - sensitivity) / (1 - false_rate))
        out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
    return np.array(out)


def _statistics(patterns: pd.DataFrame, quality: dict, prior: dict) -> pd.DataFrame:
    """Sums of probabilities by field and source: of true and false values, stated and not."""
    p = _likelihood(patterns, quality, prior)
    sums: dict[tuple[str, str], np.ndarray] = {}
    for field, pattern, n, x in zip(patterns["field_name"], patterns["pattern"], patterns["n"], p, strict=True):
        total = np.array([x, 1 - x]) * n
        for entry in pattern.split("\t"):
            sums.setdefault((field, entry[1:]), np.zeros(4))[[0, 1] if entry[0] == "+" else [2, 3]] += total
        sums.setdefault((field, ""), np.zeros(4))[:2] += total
    return pd.DataFrame([(f, s, *map(float, v)) for (f, s), v in sums.items()], columns=["field_name", "source", "true_yes", "false_yes", "true_no", "false_no"])


def infer(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[dict, dict]:
    """Sensitivity and false-positive rate of every (field, source), and the prior of every field, by expectation-maximisation."""
    n = patterns.limit(PATTERNS + 1).count()
    local = patterns.toPandas() if n <= PATTERNS else None
    names = {(f, s) for f, p in local[["field_name", "pattern"]].itertuples(index=False) for s in (e[1:] for e in p.split("\t"))} if local is not None else {
        (r[0], r[1]) for r in patterns.select("field_name", F.explode(F.split("pattern", "\t")).alias("e")).select("field_name", F.expr("substring(e, 2)")).distinct().collect()
    }
    quality, prior = dict.fromkeys(names, (0.8, 0.3)), {f: 0.5 for f, _ in names}
    for _ in range(rounds):
        if local is not None:
            sums = _statistics(local, quality, prior)
        else:

            def step(batches: Iterator[pd.DataFrame], q: dict = quality, p: dict = prior) -> Iterator[pd.DataFrame]:
                for pdf in batches:
                    yield _statistics(pdf, q, p)

            parts = patterns.mapInPandas(step, "field_name string, source string, true_yes double, false_yes double, true_no double, false_no double")
            sums = parts.groupBy("field_name", "source").sum().toDF("field_name", "source", "true_yes", "false_yes", "true_no", "false_no").toPandas()
        moved = 0.0
        for f, s, ty, fy, tn, fn in sums.itertuples(index=False):
            if s == "":
                prior[f] = (ty + 5) / (ty + fy + 10)
            else:
                new = ((ty + 8) / (ty + tn + 10), (fy + 3) / (fy + fn + 10))
                moved = max(moved, abs(new[0] - quality[f, s][0]), abs(new[1] - quality[f, s][1]))
                quality[f, s] = new
        if moved < 1e-6:
            break
    return quality, prior


def truths(records: DataFrame) -> DataFrame:
    """(dup_group_id, field_name, value, n_sources, probability, kept) of every value that a group states for a field."""
    stated = cut(claims(records))
    present = stated.groupBy("dup_group_id", "field_name").agg(F.array_sort(F.collect_set("source")).alias("present"))
    by_value = stated.groupBy("dup_group_id", "field_name", "value").agg(F.collect_set("source").alias("by"))
    pattern = F.array_join(F.transform("present", lambda s: F.concat(F.when(F.array_contains("by", s), "+").otherwise("-"), s)), "\t")
    values = cut(by_value.join(present, ["dup_group_id", "field_name"]).select("dup_group_id", "field_name", "value", F.size("by").alias("n_sources"), pattern.alias("pattern")))
    patterns = cut(values.groupBy("field_name", "pattern").agg(F.count("*").alias("n")))
    quality, prior = infer(patterns)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["field_name", "pattern"]].assign(probability=_likelihood(pdf, quality, prior))

    judged = patterns.mapInPandas(judge, "field_name string, pattern string, probability double")
    return values.join(judged, ["field_name", "pattern"]).select("dup_group_id", "field_name", "value", "n_sources", "probability", (F.col("probability") >= 0.5).alias("kept"))


def agreement(records: DataFrame) -> DataFrame:
    """(field_name, n_fields, n_contested, n_kept, n_first, n_first_contested): of the fields with a survivor by the fixed
    order, how many have several values, for how many the latent model keeps the survivor's value, and for how many it holds
    none more probable, in all and where there are several values."""
    judged = truths(records)
    best = survivors(records).withColumnRenamed("record_id", "ID")
    one = lambda f, v: records.where(f"{f} is not null").select("dup_group_id", "ID", F.lit(f).alias("field_name"), v.alias("value"))
    streets = _street_forms(one("OPS_STREET", F.col("OPS_STREET")).distinct())
    stated = streets.unionByName(one("OPS_ZIP5", F.col("OPS_ZIP5"))).unionByName(one("GEOCODE_ACCURACY", F.col("GEOCODE_ACCURACY").cast("string"))).distinct()
    chosen = best.join(stated, ["dup_group_id", "ID", "field_name"]).select("dup_group_id", "field_name", "value")
    tops = judged.groupBy("dup_group_id", "field_name").agg(F.max("probability").alias("top"), F.count("*").alias("n"))
    rows = chosen.join(judged, ["dup_group_id", "field_name", "value"]).join(tops, ["dup_group_id", "field_name"])
    first, several = F.col("probability") >= F.col("top") - 1e-12, F.col("n") > 1
    count = lambda c: F.count_if(c)
    return rows.groupBy("field_name").agg(F.count("*").alias("n_fields"), count(several).alias("n_contested"), count(F.col("kept")).alias("n_kept"), count(first).alias("n_first"), count(first & several).alias("n_first_contested"))
