"""Source tables derived from the driver's TPC-H-like parquet files.

Each canonical table is a deterministic projection of ``orders``, ``lineitem``
or ``region`` (see FIXTURES.md for the same definitions as SQL, which the DuckDB
oracle runs). Rows scale with the scale factor: one legacy right per order,
one forms-log entry per line item, one new-system incident and case per line
item of an odd supplier.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annuity.schemas import MONEY
from annuity.sources.tables import CANONICAL, SourceTables, checked_sources


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case_key(key: Column) -> Column:
    prefix = F.when(key % 10 == 0, F.lit("GB")).otherwise(F.lit("EP"))
    return F.concat(prefix, F.lpad(key.cast("string"), 7, "0"))


def _half_month(d: Column) -> Column:
    return F.make_date(F.year(d), F.month(d), F.when(F.dayofmonth(d) < 15, 1).otherwise(15))


def _cents(amount: Column) -> Column:
    return (F.round(amount).cast("bigint") / F.lit(Decimal("100.0"))).cast(MONEY)


def standing(orders: DataFrame) -> DataFrame:
    od = F.to_date("o_orderdate")
    cust = F.col("o_custkey")
    key = _case_key(F.col("o_orderkey"))
    filing_year = (F.year(od) - 1 - cust % 6).cast("int")
    reason = (F.when(cust % 5 == 0, "00").when(cust % 5 == 1, "04").when(cust % 5 == 2, "05")
              .when(cust % 5 == 3, "07").otherwise("99"))
    return orders.select(
        key.alias("application_num"),
        F.concat(key, F.when(F.col("o_orderkey") % 7 == 0, "  ").otherwise("")).alias("publication_num"),
        F.make_date(filing_year, F.month(od),
                    F.when(F.month(od) == 2, F.least(F.dayofmonth(od), F.lit(28)))
                    .otherwise(F.dayofmonth(od))).alias("filing_date"),
        F.make_date((filing_year + 2 + cust % 4).cast("int"),
                    (1 + (F.month(od) - 1 + cust % 12) % 12).cast("int"), F.lit(15)).alias("grant_date"),
        F.date_add(od, 365).alias("renewal_date"),
        F.when(cust % 4 == 0, F.date_add(od, 90)).alias("restore_date"),
        F.when(cust % 4 == 0, F.date_add(od, 104)).alias("restore_allowed_date"),
        F.when(cust % 3 == 0, F.date_add(od, 40)).alias("date_of_lor"),
        F.when(cust % 3 < 2, F.date_add(od, 400)).alias("date_lor_cancel"),
        F.when(F.col("o_orderstatus") == "P", F.date_add(od, 20)).alias("date_not_in_force"),
        reason.alias("reason_not_in_force"),
    )


def formslog(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    rf, ls, part = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_partkey")
    filed = _half_month(F.to_date("l_shipdate"))
    form = (F.when(rf == "A", 12).when((rf == "N") & (ls == "F"), 16).when(rf == "N", 28)
            .when(ls == "F", 30).otherwise(12))
    ext_months = F.round(F.col("l_tax") * 100).cast("int")
    filing_year = F.year(F.to_date("o_orderdate")) - 1 - F.col("o_custkey") % 6
    # The key is made below the join.
    return (
        lineitem.withColumn("case_key", _case_key(F.col("l_orderkey")))
        .join(orders.select("o_orderkey", "o_orderdate", "o_custkey"),
              F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .select(
            "case_key",
            form.alias("form_type_num"),
            filed.alias("date_filed"),
            F.when(part % 50 != 0, F.date_add(filed, (part % 45).cast("int"))).alias("date_actioned"),
            (F.year(filed) - filing_year + 1).cast("int").alias("last_renewal_year"),
            _cents(F.col("l_quantity") * 500 + F.col("l_linenumber")).alias("fee_taken"),
            (ext_months * 10).cast(MONEY).alias("extension_fee_taken"),
            ext_months.alias("extension_months"),
        )
    )


def reghist(standing_df: DataFrame) -> DataFrame:
    return standing_df.where(F.col("date_not_in_force").isNotNull()).select(
        F.col("application_num").alias("case_key"),
        F.col("date_not_in_force").alias("event_date"),
        F.date_add("date_not_in_force", F.length("publication_num")).alias("reg_date"),
    )


def new_system_lines(lineitem: DataFrame) -> DataFrame:
    ship = F.to_date("l_shipdate")
    line_id = F.concat_ws(
        "-", *[F.col(c).cast("string") for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]],
        ship.cast("string"), F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"))
    return lineitem.where(F.col("l_suppkey") % 2 == 1).select(
        line_id.alias("line_id"),
        F.col("l_orderkey").alias("right_id"),
        "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
        _half_month(ship).alias("date_filed"),
    )


def incident(lines: DataFrame) -> DataFrame:
    part = F.col("l_partkey")
    return lines.select(
        F.col("line_id").alias("incident_id"),
        F.col("line_id").alias("servicerequest_id"),
        "right_id",
        "date_filed",
        F.when(part % 50 != 0, F.date_add("date_filed", (part % 45).cast("int"))).alias("date_completed"),
    )


def servicerequest(lines: DataFrame) -> DataFrame:
    rf, ls, part = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_partkey")
    return lines.select(
        F.col("line_id").alias("id"),
        F.when((rf == "A") | ((rf == "R") & (ls == "O")), "Renewals").otherwise("Other").alias("type_name"),
        F.when(part % 3 == 0, (2 + part % 12).cast("int")).alias("renewal_year"),
        _cents(F.col("l_quantity") * 500).alias("prescribed_uk_fee"),
        F.when(part % 4 == 0, "Y").otherwise("N").alias("lor_indicator"),
    )


def _right_base(standing_df: DataFrame) -> DataFrame:
    reason = F.col("reason_not_in_force")
    return standing_df.select(
        F.substring("application_num", 3, 7).cast("bigint").alias("right_id"),
        "application_num", "publication_num", "filing_date", "grant_date",
        F.when(reason == "99", F.lit(6)).alias("renewal_year"),
        F.when(reason == "07", F.col("date_of_lor")).alias("next_renewal_date"),
        (F.when(reason == "00", 1).when(reason == "04", 2).when(reason == "05", 3)
         .when(reason == "07", 4).otherwise(9)).alias("termination_reason_id"),
        F.col("date_not_in_force").alias("termination_date"),
        F.col("restore_date").alias("restoration_date"),
    )


def fees(orders: DataFrame) -> DataFrame:
    cust = F.col("o_custkey")
    return orders.where(cust % 11 != 0).select(
        F.col("o_orderkey").alias("fee_id"),
        F.col("o_orderkey").alias("right_id"),
        ((cust % 30000).cast("bigint") / F.lit(Decimal("100.0"))).cast(MONEY).alias("total_fee"),
    )


def case(lines: DataFrame) -> DataFrame:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    category = (F.when((rf == "N") & (ls == "F"), 31).when(rf == "N", 17)
                .when((rf == "R") & (ls == "F"), (40 + F.col("l_partkey") % 5).cast("int"))
                .otherwise(1))
    return lines.select(
        F.col("line_id").alias("case_id"), "right_id",
        F.col("date_filed").alias("case_create_date"),
        category.alias("case_category_id"),
    )


def casecategory(region: DataFrame) -> DataFrame:
    k = F.col("r_regionkey")
    name = (F.when(k == 0, "Cessation").when(k == 1, "Expiry").when(k == 2, "Surrender")
            .when(k == 3, "Revocation").otherwise("Other"))
    return region.select((40 + k).cast("int").alias("case_category_id"), name.alias("case_category"))


def terminationreason(region: DataFrame) -> DataFrame:
    k = F.col("r_regionkey")
    name = (F.when(k == 0, "Ceased").when(k == 1, "Expired").when(k == 2, "Surrendered")
            .when(k == 3, "Revoked").otherwise("Other"))
    return region.select((k + 1).cast("int").alias("termination_reason_id"), name.alias("description"))


def licenceofright(right_df: DataFrame) -> DataFrame:
    granted = F.col("next_renewal_date")
    return right_df.where(granted.isNotNull()).select(
        "right_id",
        granted.alias("lor_granted_date"),
        F.when(F.col("right_id") % 2 == 0, F.date_add(granted, 500)).alias("lor_cancelled_date"),
    )


def registerevent(case_df: DataFrame) -> DataFrame:
    return case_df.select(
        "case_id",
        F.date_add("case_create_date", 7).alias("event_date"),
        F.when(F.col("right_id") % 9 == 0, 0).otherwise(1).alias("register_indicator"),
    )


def minimum_fee(orders: DataFrame) -> DataFrame:
    """Minimum fees for fee years 2-6 in every calendar year present in orders."""
    years = orders.select(F.year(F.to_date("o_orderdate")).alias("y")).distinct()
    r = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("r")
    return years.select("y", r).select(
        F.col("y").cast("string").alias("year_set"),
        (F.col("r") + 2).cast("string").alias("minimum_fee_year"),
        (20 + (F.col("y") % 10) * 5 + F.col("r")).cast(MONEY).cast("string").alias("minimum_fee_amount"),
    )


def fixture_tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    """Canonical source tables over the driver tables in ``sf_dir``, built on first use."""
    from functools import cache

    @cache
    def table(name: str) -> DataFrame:
        return _read(spark, sf_dir, name)

    @cache
    def std() -> DataFrame:
        return standing(table("orders"))

    @cache
    def lines() -> DataFrame:
        return new_system_lines(table("lineitem"))

    @cache
    def base() -> DataFrame:
        return _right_base(std())

    @cache
    def cases() -> DataFrame:
        return case(lines())

    return SourceTables(
        standing=std,
        formslog=lambda: formslog(table("lineitem"), table("orders")),
        reghist=lambda: reghist(std()),
        incident=lambda: incident(lines()),
        servicerequest=lambda: servicerequest(lines()),
        right=lambda: base().select("right_id", "application_num", "publication_num", "filing_date",
                                    "grant_date", "renewal_year", "next_renewal_date"),
        register_right=lambda: base().select("right_id", "application_num", "publication_num", "filing_date",
                                             "grant_date", "termination_reason_id", "termination_date",
                                             "restoration_date"),
        fees=lambda: fees(table("orders")),
        case=cases,
        casecategory=lambda: casecategory(table("region")),
        terminationreason=lambda: terminationreason(table("region")),
        licenceofright=lambda: licenceofright(base()),
        registerevent=lambda: registerevent(cases()),
        minimum_fee=lambda: minimum_fee(table("orders")),
    )


def damaged_tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    """The fixture with the legacy register stored as text, and some of its values damaged (FIXTURES.md)."""
    src = fixture_tables(spark, sf_dir)
    number = F.substring("application_num", 3, 7).try_cast("bigint")
    register = src.standing.withColumns({
        "filing_date": F.when(number % 31 == 0, "n/a").otherwise(F.col("filing_date").cast("string")),
        "grant_date": F.when(number % 37 == 0, "1999-02-30").otherwise(F.col("grant_date").cast("string")),
        "reason_not_in_force": F.when(number % 41 == 0, F.lit(None)).otherwise(F.col("reason_not_in_force").cast("int"))})
    cents = (F.col("fee_taken") * 100).cast("bigint")
    log = src.formslog.withColumns({
        "fee_taken": F.when(cents % 13 == 0, F.translate(F.col("fee_taken").cast("string"), ".", ","))
        .otherwise(F.col("fee_taken").cast("string")),
        "last_renewal_year": F.when(cents % 17 == 0, "five").otherwise(F.col("last_renewal_year").cast("string")),
        "date_filed": F.col("date_filed").cast("timestamp")})
    stored = {name: (lambda name=name: getattr(src, name)) for name in CANONICAL if name != "minimum_fee"}
    return checked_sources(stored | {"standing": register, "formslog": log}, lambda: src.minimum_fee)


def damaged_fee_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum-fee CSV as lines of text, the header first, some of them short, long or without numbers (FIXTURES.md)."""
    fees = fixture_tables(spark, sf_dir).minimum_fee
    whole = F.concat_ws(",", *fees.columns)
    year, of = F.col("year_set").cast("int"), F.col("minimum_fee_year")
    damage = (F.when((year % 2 == 0) & (of == "2"), F.concat_ws(",", "year_set", "minimum_fee_year"))
              .when((year % 3 == 0) & (of == "6"), F.concat(whole, F.lit(",extra")))
              .when((year % 2 == 1) & (of == "5"), F.concat_ws(",", "year_set", F.lit("five"), "minimum_fee_amount"))
              .when((year % 4 == 0) & (of == "5"), F.concat_ws(",", "year_set", "minimum_fee_year", F.lit("12 pounds")))
              .when((year % 5 == 0) & (of == "6"), F.concat_ws(",", F.lit(""), "minimum_fee_year", "minimum_fee_amount"))
              .otherwise(whole))
    lines = fees.select(F.lit(1).alias("_turn"), damage.alias("value"))
    header = spark.range(1).select(F.lit(0).alias("_turn"), F.lit(",".join(fees.columns)).alias("value"))
    # A few lines a year: one file, as such a list is delivered.
    return header.unionByName(lines).repartition(1).sortWithinPartitions("_turn", "value").select("value")
