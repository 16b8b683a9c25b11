"""Row outcomes, precedence, golden rollups and conservation."""

from pyspark.sql import functions as F

from orderlake.operators import rollups
from orderlake.operators.classify import (INT_LITERAL_ERROR, NONE_FLOAT_ERROR, NONE_INT_ERROR,
                                          NONE_STRIP_ERROR, accepted, classify)
from orderlake.plans.etl import compute_rollups
from orderlake.schemas import RAW_COLUMNS

RAW_SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_reason_precedence_and_values(spark):
    rows = [
        # OrderID, OrderDate, Email, Country, Product, Quantity, UnitPrice, Total
        ("1", "bad", "a", "b", "p", "x", "y", "1"),          # date wins
        ("2", "2024-01-01", "a", "b", "p", "0", "y", "1"),   # quantity (non-positive)
        ("3", "2024-01-01", "a", "b", "p", "two", "1", ""),  # quantity (not an int)
        ("4", "2024-01-01", "a", "b", "p", "2", "N/A", ""),  # price
        ("5", "2024-01-01", "", "b", "p", "2", "1.5", ""),   # accepted, total computed
        ("x", "bad", "a", "b", "p", "1", "1", "1"),          # skipped, not poison
        ("x", "2024-01-01", "a", "b", "p", "1", "1", "1"),   # poison (OrderID)
    ]
    c = classify(_raw(spark, rows)).orderBy("raw_order_id").collect()
    by = {(r["raw_order_id"], r["status"]): r for r in c}
    assert by[("1", "rejected")]["reason"] == "invalid_date"
    assert by[("1", "rejected")]["value"] == "bad"
    assert by[("2", "rejected")]["detail"] == "non-positive quantity"
    assert by[("3", "rejected")]["detail"] == INT_LITERAL_ERROR + "'two'"
    assert by[("4", "rejected")]["reason"] == "invalid_unit_price"
    ok = by[("5", "accepted")]
    assert ok["customer_email"] == "unknown@unknown.com"
    assert ok["total_amount"] == 3.0 and ok["total_was_computed"]
    assert ok["year"] == 2024 and ok["month"] == "01" and ok["day"] == "01"
    assert by[("x", "rejected")]["reason"] == "invalid_date"
    assert by[("x", "poison")]["poison_error"] == INT_LITERAL_ERROR + "'x'"
    # the poison row reached the total step, but its total was supplied
    assert not by[("x", "poison")]["total_was_computed"]


def test_missing_fields_are_poison_in_reference_order(spark):
    ok = ["1", "2024-01-01", "a", "b", "p", "1", "1.0", "1"]

    def without(i):
        r = list(ok)
        r[i] = None
        return tuple(r)

    rows = [without(RAW_COLUMNS.index(n)) for n in RAW_COLUMNS]
    got = {r["raw_order_id"] if r["raw_order_id"] else "<none>": r
           for r in classify(_raw(spark, rows)).collect()}
    out = classify(_raw(spark, rows)).collect()
    errors = [r["poison_error"] for r in out]
    statuses = [r["status"] for r in out]
    expected = {
        "OrderID": NONE_INT_ERROR, "OrderDate": NONE_STRIP_ERROR,
        "CustomerEmail": NONE_STRIP_ERROR, "Country": NONE_STRIP_ERROR,
        "Product": NONE_STRIP_ERROR, "Quantity": NONE_INT_ERROR,
        "UnitPrice": NONE_FLOAT_ERROR, "TotalAmount": None,
    }
    for n, err, st in zip(RAW_COLUMNS, errors, statuses):
        assert err == expected[n], n
        assert st == ("accepted" if n == "TotalAmount" else "poison"), n
    assert got  # frame is well formed


# Golden sample of the reference's published rollups (FIXTURES.md §2).
GOLDEN_CELLS = [
    ("", "ITALY", 4, 7145), ("", "FRANCE", 5, 4215), ("", "GERMANY", 3, 755),
    ("john", "GERMANY", 1, 4995), ("john", "SPAIN", 2, 540), ("john", "UNITED STATES", 1, 840),
    ("bob", "UNITED STATES", 2, 6000), ("sara", "ITALY", 3, 4500),
    ("charlie", "UNITED STATES", 3, 1110), ("david", "UNITED STATES", 2, 840),
    ("frank", "GERMANY", 3, 620), ("emma", "UNITED STATES", 1, 450), ("alice", "GERMANY", 2, 100),
]
GOLDEN_VIP = [("unknown@unknown.com", 12115.0, 12), ("john@gmail.com", 6375.0, 4),
              ("bob@gmail.com", 6000.0, 2), ("sara@gmail.com", 4500.0, 3),
              ("charlie@gmail.com", 1110.0, 3), ("david@gmail.com", 840.0, 2),
              ("frank@gmail.com", 620.0, 3), ("emma@gmail.com", 450.0, 1),
              ("alice@gmail.com", 100.0, 2)]
GOLDEN_MARKET = [("ITALY", 11645.0, 7), ("UNITED STATES", 9240.0, 9), ("GERMANY", 6470.0, 9),
                 ("FRANCE", 4215.0, 5), ("SPAIN", 540.0, 2)]


def _golden_raw(spark):
    rows, oid = [], 1
    for who, country, n, amount in GOLDEN_CELLS:
        email = f" {who.upper()}@gmail.com " if who else "  "
        for i in range(n):
            total = amount - (n - 1) if i == n - 1 else 1.0
            rows.append((str(oid), "2024-03-0%d" % (1 + i % 9), email, country.lower(), "Widget",
                         "1", str(total), str(total)))
            oid += 1
    return _raw(spark, rows)


def test_golden_rollups(spark):
    clean = accepted(classify(_golden_raw(spark)))
    vip = [tuple(r) for r in rollups.vip_customers(clean).collect()]
    market = [tuple(r) for r in rollups.market_performance(clean).collect()]
    assert vip == GOLDEN_VIP
    assert market == GOLDEN_MARKET


def test_one_pass_equals_three_passes_and_conserves(spark, sf):
    from orderlake.sources.fixture import raw_orders
    clean = accepted(classify(raw_orders(spark, sf))).cache()
    one = {k: [tuple(r) for r in v.collect()] for k, v in compute_rollups(clean, True).items()}
    three = {k: [tuple(r) for r in v.collect()] for k, v in compute_rollups(clean, False).items()}
    assert one == three
    totals = clean.agg(F.sum("total_amount"), F.count("order_id")).collect()[0]
    for name, rows in one.items():
        amount = sum(r[1] for r in rows)
        orders = sum(r[-1] for r in rows)
        assert orders == totals[1], name
        assert abs(amount - totals[0]) < 0.01 * len(rows) + 1e-6, name
    # ranked highest first, key ascending on ties
    vip = one[rollups.VIP]
    assert vip == sorted(vip, key=lambda r: (-r[1], r[0]))
    clean.unpersist()


def test_fixture_counts_sf0001(spark, sf):
    """FIXTURES.md §3 published counts at sf 0.001."""
    from orderlake.sources.fixture import raw_orders
    c = classify(raw_orders(spark, sf))
    got = {(r["status"], r["reason"]): r["n"] for r in
           c.groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got[("accepted", None)] == 5083
    assert got[("rejected", "invalid_date")] == 260
    assert got[("rejected", "invalid_quantity")] == 539
    assert got[("rejected", "invalid_unit_price")] == 118
    assert c.where("total_was_computed").count() == 1061


def test_no_method_beyond_what_the_jvm_compiles(spark, sf):
    """Stages whose one method would be too large run as split projections."""
    from orderlake.operators.classify import classify
    from orderlake.session import METHOD_LIMIT
    from orderlake.sources.fixture import raw_orders
    df = classify(raw_orders(spark, sf))
    assert int(spark.conf.get(METHOD_LIMIT)) <= 8000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = classify(raw_orders(spark, sf))._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(plan)
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and max(sizes) < 65535 and df.count() > 0
