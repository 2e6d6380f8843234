"""Feeds without a declared schema, messages that do not decode, and cells with line ends."""

import json

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag import schemas
from skylag.ml import training
from skylag.ml.table_index import TableIndexer, TableIndexerModel
from skylag.operators import delays, feeds
from skylag.plans import views
from skylag.sources import files
from skylag.streaming import runs

SF = "/root/testdata/sf0.001"


def records(spark, *values):
    return spark.createDataFrame([(json.dumps(v),) for v in values], "value string").select(
        F.parse_json("value").alias("record")
    )


def test_columns_are_those_of_the_data_and_no_field_is_lost(spark):
    given = [
        {"a": 1, "b": "x", "c": {"d": [1, 2]}, "e.f": True}, {"a": 2.5, "b": 7, "g'h": None, "A": "capital"},
        {}, {"n": 10**30}, {"b": [1]},
    ]
    df = records(spark, *given)
    schema = feeds.open_schema(df)
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert kinds == {"A": "string", "b": "string", "c": "string", "e.f": "boolean", "g'h": kinds["g'h"], "n": "double"}
    rows = feeds.open_columns(df, schema).collect()
    got = [{k: v for k, v in r.asDict().items() if v is not None} for r in rows]
    assert got[0] == {"b": "x", "c": '{"d":[1,2]}', "e.f": True, "rest": '{"a":1}'}
    assert got[1] == {"b": "7", "A": "capital", "rest": '{"a":2.5}'}
    assert got[2] == {} and got[4] == {"b": "[1]"}


def test_late_and_misfitting_fields_are_in_the_rest(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    rows = feeds.open_columns(records(spark, {"a": "word", "b": "x"}, {"a": None, "z": {"y": 1}}, [1, 2], {"a": 3}), schema)
    assert [tuple(r) for r in rows.collect()] == [
        (None, "x", '{"a":"word"}'), (None, None, '{"z":{"y":1}}'), (None, None, "[1,2]"), (3, None, None),
    ]
    assert feeds.open_columns(records(spark, {"a": 1}).limit(0)).columns == ["rest"]
    assert feeds.open_schema(records(spark, [1], "x")) == T.StructType()


def test_what_does_not_decode_is_kept_and_counted(spark, path):
    bodies = [b'{"a": "1"}', b"{", b"", None, b'{"a": "\xff"}', b'{"a": "1"}{"a": "2"}', b"[1]", b"{}"]
    schema = T.StructType([T.StructField("a", T.StringType())])
    spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, b in enumerate(bodies)], "key int, value binary").write.parquet(f"{path}/in")
    batch = spark.read.parquet(f"{path}/in")
    out = feeds.decode_or_reject(batch, schema, keep=("key",))
    got = {r.key: (r.decoded, r.a, r.rejected) for r in out.collect()}
    assert got == {
        0: (True, "1", None), 1: (False, None, "{"), 2: (False, None, ""), 3: (False, None, ""),
        4: (False, None, '{"a": "�"}'), 5: (False, None, '{"a": "1"}{"a": "2"}'), 6: (False, None, "[1]"), 7: (True, None, None),
    }
    plain = feeds.decode_json(batch, schema, keep=("key",)).select("key").collect()
    assert sorted(r.key for r in plain) == sorted(k for k, v in got.items() if v[0])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    # a stream: one write has both outputs, and the query reports the counts
    stream = feeds.decode_or_reject(spark.readStream.schema(batch.schema).parquet(f"{path}/in"), schema, keep=("key",), observe="decoding")
    query = (
        stream.writeStream.partitionBy("decoded").option("checkpointLocation", f"{path}/state")
        .trigger(**runs.BOUNDED).start(f"{path}/out")
    )
    query.awaitTermination()
    counts = runs.observed(query, "decoding")
    assert counts == {"messages": 8, "decoded": 2, "rejected": 6}
    assert spark.read.parquet(f"{path}/out/decoded=false").count() == 6


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_cells_with_line_ends_survive_csv(spark, path, compression):
    texts = ["a\nb", '"\r\n"', "x\ry,\n", "\n", "", None, "plain", '",\n"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").coalesce(1)
    files.write_csv(df, f"{path}/t", compression)
    assert [tuple(r) for r in files.scan_csv(spark, f"{path}/t", df.schema).orderBy("id").collect()] == list(enumerate(texts))


def test_quoted_line_ends_stay_inside_their_cell(spark):
    body = 'station_id,raw_text,temp_c\nEPWA,"a\nb, ""c""\r\nd",1\n\nEDDF,plain,2\r\nLFPG,"open,3'
    rows = feeds.csv_documents(spark.createDataFrame([(body,), ("",), ("only,header",)], "value string")).collect()
    got = [(r.record["station_id"], r.record["raw_text"], r.record["temp_c"]) for r in rows]
    assert got[:2] == [("EPWA", 'a\nb, "c"\r\nd', "1"), ("EDDF", "plain", "2")]
    assert len(got) == 3 and got[2][0] == "LFPG"


def test_one_pass_gives_the_three_tables(spark):
    facts = views.prepared(spark, SF)
    levels = delays.all_levels(facts)
    for level, table in (("day", delays.daily(facts)), ("month", delays.monthly(facts)), ("entity", delays.by_entity(facts))):
        mine = delays.level_table(levels, level)
        assert mine.columns == table.columns
        assert sorted(map(str, mine.collect())) == sorted(map(str, table.collect()))


@pytest.mark.parametrize("reg", [0.0, 0.1, 50.0])
def test_sums_of_products_fit_as_the_iterations_do(spark, reg):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4)) * [1, 10, 0.1, 0] + [5, -3, 1000, 7]
    y = 3 * x[:, 0] - x[:, 1] + 50 * (x[:, 2] - 1000) + rng.normal(size=300) + 100
    columns = ["a", "b", "c", "constant"]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], ", ".join(f"{c} double" for c in [*columns, "y"]))
    if not reg:
        columns = columns[:3]  # without a penalty the other one has no closed form beside a constant
    mine = training.gram_ridge(df.unionByName(df.limit(1).withColumn("a", F.lit(None).cast("double"))), columns, "y", reg)
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(df)
    other = LinearRegression(labelCol="y", regParam=reg, elasticNetParam=0.0, maxIter=200, tol=1e-12).fit(vectors)
    assert mine.coefficients == pytest.approx(other.coefficients.toArray().tolist(), rel=1e-6, abs=1e-9)
    assert mine.intercept == pytest.approx(other.intercept, rel=1e-6)
    with pytest.raises(ValueError):
        training.gram_ridge(df.limit(0), columns, "y")


def test_labels_as_a_table_give_the_indices_of_the_built_in_indexer(spark, path):
    texts = ["b", "a", "b", "c", "a", None, "d", "b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").repartition(3)
    fresh = spark.createDataFrame([(0, "a"), (1, "new"), (2, None), (3, "d")], "id int, t string")
    for how in ("keep", "skip"):
        model = TableIndexer(inputCol="t", outputCol="i", handleInvalid=how).fit(df)
        model.save(f"{path}/{how}")
        other = StringIndexer(inputCol="t", outputCol="i", handleInvalid=how).fit(df)
        for m in (model, TableIndexerModel.load(f"{path}/{how}")):
            assert sorted(m.transform(fresh).collect()) == sorted(other.transform(fresh).collect())
    strict = TableIndexer(inputCol="t", outputCol="i", handleInvalid="error").fit(df)
    assert strict.transform(fresh.filter("id = 3")).first().i == 3.0
    with pytest.raises(Exception, match="no index: new"):
        strict.transform(fresh.filter("id = 1")).collect()
