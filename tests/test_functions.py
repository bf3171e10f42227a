import math

from pyspark.sql import functions as F

from hailstat.functions import grid, keys, text, times


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_salted_key(spark):
    assert one(spark, keys.salted_key(F.lit("1_20200120180752"))) == ("0004a97f493208b0",)


def test_hash_equals_the_jvm_hash(spark):
    samples = ["", "a", "1_20200120180752", "päckchen", "订单", "x\U0001f695y", "~" * 60]
    for sample in samples:
        expected = spark._jvm.java.util.Objects.hashCode(sample) % 2**32
        assert one(spark, keys.string_hash(F.lit(sample))) == (expected,), sample


def test_prefixed_keys(spark):
    assert one(spark, keys.plain_key(F.lit(1), F.lit("b"))) == ("1b",)
    key = one(spark, keys.hash_prefixed_key(F.lit("ab")))[0]
    assert bytes(key) == (ord("a") * 31 + ord("b")).to_bytes(2, "big") + b"ab"
    digest = one(spark, F.md5(F.lit("a_b")))[0]
    for length, kept in ((3, 8), (12, 12), (40, 32)):
        assert one(spark, keys.md5_prefixed_key("_", length, F.lit("a"), F.lit("b"))) == (digest[:kept] + "_a_b",)


def test_business_key(spark):
    assert one(
        spark,
        keys.business_key(F.lit("7"), F.lit("2020-01-20 18:07:52")),
        keys.business_key(F.lit("7"), F.lit("2020-01-20")),
        keys.timed_key(F.lit("7"), F.lit("2020-01-20 18:07:52").cast("timestamp")),
    ) == ("7_20200120180752", None, "7_20200120180752")


def test_times(spark):
    assert one(
        spark,
        times.format_seconds(F.lit(1568025609)),
        times.format_millis(F.lit(1568025609176)),
        times.hour_of(F.lit(1568025609)),
        times.compact_date(F.lit("2020-01-20")),
        times.compact_date(F.lit("  ")),
        times.half_month_back(F.lit("202003011230")),
        times.half_month_back(F.lit("no time")),
        times.table_suffix(F.lit("2019-11-03").cast("timestamp")),
        times.table_suffix(F.lit("2019-10-03").cast("timestamp")),
    ) == (
        "2019-09-09 10:40:09", "2019-09-09 10:40:09", 10, "20200120", None, "202002151230", None, "201911", "201910",
    )


def test_rate_text(spark):
    assert one(
        spark,
        text.rate_text(F.lit(2), F.lit(3)),
        text.rate_text(F.lit(2), F.lit(2)),
        text.rate_text(F.lit(0), F.lit(2)),
        text.rate_text(F.lit(1), F.lit(0)),
    ) == ("66.67%", "100.0%", "0.0%", None)


def test_amounts(spark):
    assert one(spark, text.amount_text(F.lit(12345678901.125)), text.count_text(F.lit(None).cast("bigint"))) == (
        "12345678901.13", "0",
    )
    small = spark.range(100_000).select(F.lit(0.00004).alias("v"))
    assert abs(small.agg(text.amount_sum(F.col("v"))).first()[0] - 4.0) < 1e-6
    assert one(spark, F.lit(1.0), F.lit(2.0)) and spark.createDataFrame([(1e15,), (1.0,)], "v double").agg(
        text.amount_sum(F.col("v"))
    ).first()[0] == 1e15 + 1


def test_records(spark):
    df = spark.createDataFrame([("1", None, 2)], "id string, name string, n int")
    assert df.select(text.json_object(["id", "n"])).first()[0] == '{"id":"1","n":"2"}'
    assert df.select(text.record_map(["id", "name", "n"])).first()[0] == {"id": "1", "name": None, "n": "2"}


def test_markup_filter(spark):
    def clean(html):
        return one(spark, text.strip_unsafe_markup(F.lit(html)))[0]

    assert clean("a<SCRIPT type='x'>\nalert(1)\n</Script >b") == "ab"
    assert clean("a< style>p{}</style>b") == "ab"
    assert clean("a<iframe src='x'>y</iframe>b<frameset>z</frameset>c") == "abc"
    assert clean("<p ONclick='x()'>t</p>") == "<p 'x()'>t</p>"
    assert clean("<a HREF=javascript:go>t</a>") == "<a go>t</a>"
    assert clean("a<link rel='x' />b<link rel='y'>") == "ab<link rel='y'>"


def _scatter(spark, n=2000):
    return spark.range(n).select(
        (F.lit(19.0) + (F.col("id") * 7919 % 20000) / 10000).alias("lat"),
        (F.lit(109.0) + (F.col("id") * 104729 % 20000) / 10000).alias("lng"),
    )


def test_cells_hold_their_points(spark):
    for res in (5, 7, 12):
        points = _scatter(spark).withColumn("cell", grid.cell_of(F.col("lat"), F.col("lng"), res))
        center = grid.cell_center(F.col("cell"))
        dx = (F.col("lng") - center["lng"]) * grid.LNG_METRES
        dy = (F.col("lat") - center["lat"]) * grid.METRES_PER_DEGREE
        farthest = points.agg(F.max(F.sqrt(dx * dx + dy * dy))).first()[0]
        assert farthest <= grid.edge_length(res) * 1.000001
        back = points.withColumn("again", grid.cell_of(center["lat"], center["lng"], res))
        assert back.where("again <> cell").count() == 0


def test_cell_area_shrinks_by_seven():
    assert math.isclose((grid.edge_length(7) / grid.edge_length(8)) ** 2, 7)


def test_corners_lie_one_edge_from_the_center(spark):
    cells = _scatter(spark, 50).select(grid.cell_of(F.col("lat"), F.col("lng"), 7).alias("cell"))
    center = grid.cell_center(F.col("cell"))
    corner = cells.select("cell", center.alias("c"), F.explode(grid.cell_boundary(F.col("cell"))).alias("p"))
    dx = (F.col("p.lng") - F.col("c.lng")) * grid.LNG_METRES
    dy = (F.col("p.lat") - F.col("c.lat")) * grid.METRES_PER_DEGREE
    low, high = corner.agg(F.min(F.sqrt(dx * dx + dy * dy)), F.max(F.sqrt(dx * dx + dy * dy))).first()
    assert math.isclose(low, 1200, rel_tol=1e-6) and math.isclose(high, 1200, rel_tol=1e-6)


def test_null_point_has_no_cell(spark):
    assert one(spark, grid.cell_of(F.lit(None).cast("double"), F.lit(110.0), 7)) == (None,)


def test_centroid(spark):
    def middle(points):
        df = spark.createDataFrame(points, "lat double, lng double")
        p = df.agg(grid.centroid(F.col("lat"), F.col("lng")).alias("p")).first()["p"]
        array = df.agg(F.collect_list(F.struct("lng", "lat")).alias("a")).select(grid.array_centroid(F.col("a")).alias("p"))
        q = array.first()["p"]
        assert math.isclose(p["lng"], q["lng"], abs_tol=1e-9) and math.isclose(p["lat"], q["lat"], abs_tol=1e-9)
        return p["lng"], p["lat"]

    lng, lat = middle([(1.0, 10.0), (-1.0, 10.0), (0.0, 9.0), (0.0, 11.0)])
    assert math.isclose(lng, 10.0) and abs(lat) < 1e-9
    lng, _ = middle([(0.0, 179.0), (0.0, -179.0)])
    assert math.isclose(abs(lng), 180.0)
