"""Laboratory tables derived from the provided retail tables.

Orders play samples, customers play producers, order lines play tested packages, suppliers play lab
technicians and nations play clients. Every lineitem row carries one result per test parameter, minus
some left out by a rule, so that gaps exist. Everything is derived lazily and by plain projections;
only the list of order lines needs an aggregation, since a package occurs several times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARAMETERS = {  # code to name; the position is the number used by the rules below
    "UM0004ZH": "Bacteria Count",
    "Z001JJPC": "Delvo Inhibitor",
    "JJ00047N": "Somatic cells",
    "P003": "Freezing point",
    "P004": "Analysis Temperature",
    "7027A006": "Fat",
    "P006": "True Protein",
    "P007": "Coliforms",
    "P008": "Lactose",
    "P009": "Solids not fat (SNF)",
    "P010": "Other Solids",
    "P011": "Milk Urea Nitrogen (MUN)",
    "P012": "Bacteria",
    "P013": "Gram negative Bacteria",
    "P014": "Prototheca species",
    "P015": "Pre-incubation Count (PI)",
    "P016": "Bacteria Count(PI)",
    "P017": "Pregnancy",
    "P018": "Thermoduric Plate Count",
    "P019": "Alkylphenolethoxylates",
    "P020": "Staphylococcus aureus",
    "P021": "Staphylococcus species",
    "P022": "Streptococci agalactiae",
    "P023": "Streptococcus species",
    "P024": "Mycoplasma species",
    "P025": "Bulk Tank Coliforms",
    "P026": "Lab Pasteurized Count",
}
COMMON, RARE = 12, 16  # parameters before the first are measured often, those from the second rarely
TESTS = (
    "MVQVP52A", "MVPQVP2", "MVPQVP6", "MVPQVP8b", "MVPQVP9", "MVPQVPAb", "MVPQVPG", "MVPQVPB",
    "MVPQVP8", "MVQVP52B", "MVQVP41",
)
COUNTS = (0, 2, 12)  # some of these counts cannot be read as numbers
HUNDREDTHS = (5, 6, 8, 9, 10, 11)
ITEMS = ("MVPQVP1", "MVPQVP2", "MVPQVP8", "MVPQVPG", "EXTRA5", "EXTRA6", "EXTRA7")
STATES = ("IA", "MN", "WI", "TN", "MO")


_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
                " l_quantity double, l_returnflag string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey bigint, s_name string",
}


def _pick(values: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def _inline(spark: SparkSession, columns: str, rows: list[tuple[str, ...]]) -> DataFrame:
    """A literal table whose size the optimizer knows."""
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


class _OnDemand(dict):
    """Tables by name, each defined when first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self._builders = builders

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._builders[name]()
        return self[name]


def lab_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def read(name: str) -> DataFrame:
        return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    mapped = [
        (item, parameter)
        for i, item in enumerate(ITEMS, 1)
        for n, parameter in enumerate(PARAMETERS)
        if (i + n) % 6
    ]
    return _OnDemand({
        "reportable_result": lambda: _results(read("lineitem")),
        "commercial_order_line": lambda: _order_lines(
            read("lineitem"), read("orders"), read("customer")
        ),
        "sample": lambda: _samples(read("orders")),
        "commercial_order": lambda: read("nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.col("n_nationkey").cast("bigint").alias("customer_framework_id"),
            F.concat(F.lit("CO-"), "n_nationkey").alias("commercial_order_code"),
        ),
        "customer_framework": lambda: read("nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.col("n_name").alias("internal_name"),
            F.concat(F.lit("ASC"), "n_nationkey").alias("customer_code"),
        ),
        "producer": lambda: _producers(read("customer"), read("nation")),
        "producer_list": lambda: _memberships(read("customer")),
        "producer_group": lambda: _groups(spark, read("customer")),
        "result_set": lambda: read("supplier").select(
            F.col("s_suppkey").alias("sequence_number"), F.col("s_name").alias("operator_code")
        ),
        "commercial_item": lambda: _inline(
            spark, "commercial_item_code", [(i,) for i in ITEMS[:-1]]
        ),
        "commercial_item_test_parameter_map": lambda: _inline(
            spark, "commercial_item_id, test_parameter_code", mapped
        ),
        "test_parameter": lambda: _inline(
            spark, "test_parameter_code, test_parameter_name", list(PARAMETERS.items())
        ),
    })


def _results(lineitem: DataFrame) -> DataFrame:
    n = F.col("n")
    by_part = F.array(*[F.array(*[F.lit(k) for k in _measured(part)]) for part in range(20)])
    measured = lineitem.withColumn("n", F.explode(F.get(by_part, (F.col("l_partkey") % 20).cast("int"))))
    amount = (F.col("l_quantity") * 30 + n * 7).cast("int")
    outcome = (
        F.when(F.col("l_suppkey") % 7 == 1, "Positive")
        .when(F.col("l_suppkey") % 7 == 2, "Not Found")
        .otherwise("NOT FOUND")
    )
    hundredths = F.concat(
        F.floor(amount / 100).cast("string"), F.lit("."), F.lpad((amount % 100).cast("string"), 2, "0")
    )
    value = (
        F.when(n == 1, outcome)
        .when(n.isin(*COUNTS) & (F.col("l_suppkey") % 19 == 5), ">3000")
        .when((n == 3) & (F.col("l_suppkey") % 13 == 0), "")
        .when((n == 14) & (F.col("l_suppkey") % 3 == 0), "")
        .when(n == 4, (amount % 10).cast("string"))
        .when(n.isin(*HUNDREDTHS), hundredths)
        .otherwise(amount.cast("string"))
    )
    validated = F.timestamp_add("HOUR", (F.col("l_suppkey") % 24).cast("int"), "l_shipdate")
    return measured.select(
        _line_id().alias("commercial_order_line_id"),
        validated.alias("result_validation_date"),
        F.when(F.col("l_partkey") % 4 != 0, F.timestamp_add("DAY", F.lit(-1), validated)).alias(
            "result_measured_time"
        ),
        F.when(F.col("l_returnflag") == "A", "MVPQVP1")
        .when(F.col("l_returnflag") == "N", _pick(TESTS, F.col("l_suppkey") % len(TESTS) + 1))
        .otherwise("MVPQVPX")
        .alias("commercial_test_code"),
        _pick(tuple(PARAMETERS), n + 1).alias("commercial_parameter_code"),
        value.alias("aggregated_value"),
        F.col("l_suppkey").alias("result_set_sequence_no"),
    )


def _measured(part: int) -> list[int]:
    """Numbers of the parameters measured for a part; they repeat with every twentieth part."""
    def taken(n: int) -> bool:
        if n < COMMON:
            return (part + 3 * n) % 5 != 0
        return (part + 3 * n) % (5 if n < RARE else 20) == 1

    return [n for n in range(len(PARAMETERS)) if taken(n)]


def _line_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


#: Line numbers up to this one are kept as bits.
_MOST_BIT = 62


def _order_lines(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    client = customer.select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_nationkey").cast("bigint").alias("commercial_order_id"),
    )
    heads = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    # an order's lines are bits of one number through the joins; a line of another number has a row of its own
    n, one = F.col("l_linenumber"), F.lit(1).cast("bigint")
    bit = F.coalesce(n.between(0, _MOST_BIT), F.lit(False))
    numbers = lineitem.groupBy("l_orderkey", F.when(~bit, F.struct(n)).alias("other")).agg(
        F.bit_or(F.when(bit, F.call_function("shiftleft", one, n))).alias("bits")
    )
    every = F.array(*[F.struct(F.lit(k).alias("l_linenumber")) for k in range(_MOST_BIT + 1)])
    own = F.filter(every, lambda k: F.col("bits").bitwiseAND(F.call_function("shiftleft", one, k["l_linenumber"])) != 0)
    each = F.when(F.col("other").isNull(), own).otherwise(F.array("other"))
    return (
        numbers.join(heads, "l_orderkey")
        .join(client, "o_custkey")
        .select("l_orderkey", "commercial_order_id", "o_orderstatus", F.inline(each))
        .select(
            _line_id().alias("id"),
            F.col("l_orderkey").alias("sample_id"),
            "commercial_order_id",
            _pick(ITEMS, F.col("l_linenumber")).alias("commercial_item"),
            F.when(F.col("o_orderstatus") == "P", "Pending")
            .otherwise("Completed")
            .alias("commercial_order_line_status"),
        )
    )


def _samples(orders: DataFrame) -> DataFrame:
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("bigint")
    taken = F.make_timestamp_ntz(
        F.year("o_orderdate"), F.lit(1), F.lit(1), F.lit(3), F.lit(0), F.lit(0)
    )
    digits = key.cast("string")
    return orders.select(
        key.alias("id"),
        F.col("o_custkey").alias("producer_id"),
        F.when(key % 101 == 0, F.lpad(digits, 10, "0")).otherwise(F.lpad(digits, 14, "0")).alias(
            "bar_code"
        ),
        F.when(key % 97 != 0, F.col("o_orderpriority")).alias("tank"),
        F.when(key % 89 != 0, taken).alias("sampling_time"),
        F.when(key % 53 != 0, price % 45).cast("decimal(9,2)").alias("temperature_at_sampling"),
        (price % 40).cast("decimal(9,2)").alias("temperature_at_registration"),
        F.when(key % 22 == 0, "n/a")
        .when(key % 11 == 0, "N/A")
        .when(key % 13 != 0, F.concat(F.lit("W"), (key % 52).cast("string")))
        .alias("billing_week"),
        F.concat(F.lit("CHR"), (key % 1000).cast("string")).alias("chr_number"),
        F.concat(F.lit("CKR"), (F.col("o_custkey") % 1000).cast("string")).alias("ckr_number"),
    )


def _producers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    key, area = F.col("c_custkey"), F.col("c_nationkey")
    place = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")

    def label(prefix: str, number: Column) -> Column:
        return F.concat(F.lit(prefix), number.cast("string"))

    return customer.join(place, "c_nationkey").select(
        key.alias("id"),
        F.col("c_name").alias("producer_code"),
        label("Farm ", key).alias("producer_name"),
        F.when(key % 41 != 0, _pick(STATES, F.col("n_regionkey") + 1)).alias("region"),
        _pick(STATES, (area + 1) % 5 + 1).alias("state"),
        F.concat(F.lit("REP "), "n_name").alias("state_rep"),
        F.col("c_mktsegment").alias("field_rep"),
        label("P", key).alias("permit_number"),
        label("B", area).alias("btu_number"),
        F.when(key % 3 == 0, "").when(key % 3 == 2, "A").alias("grade"),
        label("R", area).alias("route_number"),
        label("V", key % 10).alias("visit_number"),
    )


def _memberships(customer: DataFrame) -> DataFrame:
    """Two groups for every third producer, none for those ending in 9, else one."""
    own = F.ascii("c_mktsegment").cast("bigint")
    groups = (
        F.when(F.col("c_custkey") % 3 == 0, F.array(own, F.lit(0).cast("bigint")))
        .when(F.col("c_custkey") % 10 != 9, F.array(own))
    )
    return customer.select(
        F.col("c_custkey").alias("producer_id"), F.explode(groups).alias("producer_group_id")
    )


def _groups(spark: SparkSession, customer: DataFrame) -> DataFrame:
    own = customer.select(
        F.ascii("c_mktsegment").cast("bigint").alias("id"),
        F.col("c_mktsegment").alias("producer_group_name"),
    ).distinct()
    third = spark.sql("SELECT CAST(0 AS BIGINT) AS id, 'EVERY THIRD' AS producer_group_name")
    return own.unionByName(third)
