"""Queries over addresses: the same one written differently, and matches across sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.functions.keys import key_form
from cairnfield.llm import cross_match, same_address
from cairnfield.session import cut
from cairnfield.sources.tables import read


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    sales, others = read(spark, folder, "dim_location_sales_order"), ("SUPPLEMENTAL", "ATTENTION", "DEPARTMENT", "RECEIVER")
    lexicon = same_address.learn(sales, "STREET", others)
    sales = sales.where(key_form(F.col("OPS_LOCATION_ID")).isNull())
    return same_address.parsed(sales, read(spark, folder, "zip_reference"), "ID", "STREET", "CITY", "STATE", "ZIP5", "STREET_NUM", others, lexicon)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of unlinked sales-order records that denote the same location."""
    return same_address.pairs(same_address.locations(_raw(spark, folder)))


def p4_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Each unlinked sales-order record that denotes a location with the smallest id of its location and how many others."""
    return same_address.classes(same_address.locations(_raw(spark, folder)))


def _forms(rows: DataFrame, source: str) -> DataFrame:
    """(source, id, form, parts) of the parsed rows that state an address; `form` stands for the parts."""
    parts = ["number", "direction", "name", "suffix", "place", "zip"]
    rows = rows.where("number <> '' and name <> '' and place <> ''")
    return rows.select(F.lit(source).alias("source"), F.col("id").cast("string").alias("id"), *parts, F.concat_ws("\t", *parts).alias("form")).distinct()


#: Parts of a form beside number, name and city.
PART = ("direction", "suffix", "zip")


def _pairs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The forms asked for (source, id, form and parts), the listed ones, the pairs of both with their features, and which
    form is true for the records of the samples."""
    zips = read(spark, folder, "zip_reference")
    ops, dnb, keep = (read(spark, folder, n) for n in ("ops_location", "dim_location_dnb", "dim_location_keepstock"))
    streets = dnb.select(F.col("PHYS_STRT_AD").alias("street")).unionByName(keep.select(F.col("ADDRESS1").alias("street")))
    lexicon = same_address.learn(streets, "street")

    def forms(df: DataFrame, source: str, street: str, city: str, state: str, code: str) -> DataFrame:
        return _forms(same_address.parsed(df, zips, "ID", street, city, state, code, lexicon=lexicon), source)

    listed = ops.where("IS_ADDRESS").select("*", key_form(F.col("ID")).alias("k"))
    claimed = cut(ops.select(key_form(F.col("DNB_DIM_LOCATION_ID")).alias("k"), F.when(F.col("IS_ADDRESS"), F.col("ID")).alias("ops")).where("k is not null").distinct())
    lowest = lambda rows: rows.orderBy(F.xxhash64("id"), "id").limit(cross_match.SAMPLE_ROWS)
    third = cut(forms(dnb, "dnb", "PHYS_STRT_AD", "PHYS_CTY", "PHYS_ST_ABRV", "PHYS_ZIP5").withColumn("k", key_form(F.col("id"))))
    loose = third.join(claimed, "k", "left_anti").drop("k")
    of_dnb = lowest(third.join(claimed.where("ops is not null"), "k").select("id", "ops").distinct())
    key = key_form(F.col("OPS_LOCATION_ID"))
    stock = forms(keep.where(key.isNull()), "keepstock", "ADDRESS1", "CITY", "PROVINCE", "ZIP5")
    of_stock = lowest(keep.select(F.col("ID").cast("string").alias("id"), key.alias("k")).where("k is not null").join(listed.select("k", F.col("ID").alias("ops")), "k").select("id", "ops").distinct())
    keyed = forms(keep.join(of_stock.select(F.col("id").cast("bigint").alias("ID")), "ID", "left_semi"), "keyed keepstock", "ADDRESS1", "CITY", "PROVINCE", "ZIP5")
    sample = keyed.unionByName(third.drop("k").join(of_dnb.select("id"), "id", "left_semi").withColumn("source", F.lit("keyed dnb")).select(*keyed.columns))
    asked = cut(loose.unionByName(stock).unionByName(sample))
    found = cut(forms(listed, "ops", "OPS_STREET", "OPS_CITY", "OPS_STATE", "OPS_ZIP5"))
    core = lambda x: x.select("number", "place", "name").distinct().withColumn("form", F.concat_ws("\t", "number", "place", "name"))
    close = cut(cross_match.close_pairs(core(asked), core(found)))
    vectors = [f"{p}_v" for p in PART]
    side = lambda x, s: cross_match.encoded_parts(x.select("form", "number", "place", "name", *PART).distinct()).select(F.concat_ws("\t", "number", "place", "name").alias(s), F.col("form").alias(f"form_{s}"), *[F.col(p).alias(f"{p}_{s}") for p in (*PART, *vectors)])
    features = cut(cross_match.scored(close.join(side(asked, "l"), "l").join(side(found, "r"), "r")).select("r", "form_l", "form_r", "direction_r", "suffix_r", *cross_match.FEATURES))
    truth = of_stock.withColumn("source", F.lit("keyed keepstock")).unionByName(of_dnb.withColumn("source", F.lit("keyed dnb"))).join(found.select(F.col("id").alias("ops"), F.col("form").alias("true_r")), "ops").select("source", "id", "true_r").distinct()
    return asked, found, features, cut(truth)


def _labelled(asked: DataFrame, features: DataFrame, truth: DataFrame) -> DataFrame:
    """The pairs of the samples' records with `same`, and `held` of the third that isn't fitted on."""
    rows = asked.select("source", "id", F.col("form").alias("form_l")).join(truth, ["source", "id"]).join(features, "form_l")
    return rows.select("source", "id", "form_l", "form_r", "true_r", *cross_match.FEATURES, (F.col("form_r") == F.col("true_r")).alias("same"), (F.pmod(F.xxhash64("id", "source"), F.lit(3)) == 0).alias("held"))


def _scored(asked: DataFrame, features: DataFrame, truth: DataFrame) -> DataFrame:
    """(form_l, address, confidence). The zip of a listed address tells nothing apart, so addresses compete by their other parts."""
    weights = cross_match.fit(cross_match.patterns(_labelled(asked, features, truth).where("not held")).toPandas())
    return cross_match.confidences(features.withColumn("address", F.concat_ws("\t", "r", "direction_r", "suffix_r")), weights, "form_l", "address")


def _addresses(found: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("ops_id"), "form", F.concat_ws("\t", "number", "place", "name", "direction", "suffix").alias("address")).distinct()


def _matches(spark: SparkSession, folder: str) -> DataFrame:
    """(source, id, ops_id, confidence) of every third-party record without a key and each address record it may denote."""
    asked, found, features, truth = _pairs(spark, folder)
    rows = asked.where("source in ('dnb', 'keepstock')").select("source", "id", F.col("form").alias("form_l"))
    return rows.join(_scored(asked, features, truth), "form_l").join(_addresses(found).drop("form"), "address").select("source", "id", "ops_id", "confidence").distinct()


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each third-party record without a key and each address record that it more likely than not denotes."""
    return _matches(spark, folder).where("confidence > 0.5").select(F.col("source").alias("source_table"), F.col("id").cast("bigint").alias("source_id"), F.col("ops_id").alias("ops_location_id")).distinct()


def p6_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """Every match that was considered, with its confidence."""
    return _matches(spark, folder).select(F.col("source").alias("source_table"), F.col("id").cast("bigint").alias("source_id"), F.col("ops_id").alias("ops_location_id"), F.round("confidence", 6).alias("confidence"))


def p6_calibration(spark: SparkSession, folder: str) -> DataFrame:
    """Of the keyed records that the confidence was not fitted on: matches by tenth of confidence, the mean confidence and
    the share that is true; matches of the true address by another record of it count as true."""
    asked, found, features, truth = _pairs(spark, folder)
    held = _labelled(asked, features, truth).where("held").select("source", "id", "form_l", "true_r").distinct()
    right = held.join(_addresses(found).select(F.col("form").alias("true_r"), F.col("address").alias("true")), "true_r").select("source", "id", "form_l", "true").distinct()
    rows = right.join(_scored(asked, features, truth), "form_l").groupBy("source", "id", "address").agg(F.max("confidence").alias("confidence"), F.max((F.col("address") == F.col("true")).cast("int")).alias("hit"))
    bins = rows.groupBy(F.least(F.floor(F.col("confidence") * 10), F.lit(9)).alias("tenth"))
    return bins.agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 4).alias("mean_confidence"), F.round(F.avg("hit"), 4).alias("share_true"))


QUERIES = {f.__name__: f for f in (p4_found, p4_classes, p6_found, p6_confidence, p6_calibration)}
SQL: dict[str, str] = {}
