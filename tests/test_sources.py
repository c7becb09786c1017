import os

import pytest
from pyspark.sql import types as T

from stellate.sources.files import (
    ambiguous_labels, demographics_rejects, read_delimited, read_demographics, read_lookup, temperatures_rejects,
)

# Invented labels with the defects of a hand-made code book.
COUNTRY_CSV = (
    "\ufeffcountry_code,Country\r\n"
    '11,"OCEANIA Sea, Air (A-1, by any route)"\r\n'
    "12,RURITANIA \r\n"
    "13,UNKNOWN: NO PAPERS\r\n"
    "14,UNKNOWN: NO PAPERS\r\n"
    "15,Code not in use (15) ;\r\n"
    " 16 ,PADDED\r\n"
    "NA,NULL\r\n"
)


def _write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)
    return path


def test_lookup_clean_and_raw(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "country.csv"), COUNTRY_CSV)
    clean = [tuple(r) for r in read_lookup(spark, path, "country").collect()]
    assert clean[0] == (11, "OCEANIA Sea, Air (A-1, by any route)")
    assert (12, "RURITANIA") in clean
    assert (15, "Code not in use (15)") in clean
    assert (16, "PADDED") in clean
    assert (None, None) in clean  # NA / NULL tokens
    raw = [tuple(r) for r in read_lookup(spark, path, "country", clean=False).collect()]
    assert (12, "RURITANIA ") in raw and (15, "Code not in use (15) ;") in raw
    labels = [tuple(r) for r in ambiguous_labels(read_lookup(spark, path, "country"), "country_code", "Country").collect()]
    assert labels == [("UNKNOWN: NO PAPERS", 2, "13", "14")]
    assert read_lookup(spark, path, "country").schema["country_code"].dataType == T.IntegerType()


def test_null_tokens_and_types(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "demog.csv"),
                  "City;State;Median Age;Male Population;Female Population;Total Population;"
                  "Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count\n"
                  "Austin;Texas;31.3;NA;480000.0;931830;;NULL;2.58;TX;Asian;86400\n"
                  "Bad;X;abc;1;2;3;4;5;6;XX;R;7\n")
    rows = read_demographics(spark, path, malformed="null").collect()
    a = rows[0]
    assert a["Median Age"] == 31.3 and a["Male Population"] is None
    assert a["Number of Veterans"] is None and a["Foreign-born"] is None
    assert a["Total Population"] == 931830 and a["Count"] == 86400
    assert rows[1]["Median Age"] is None
    # By default the row is left out, and counted.
    assert [r.City for r in read_demographics(spark, path).collect()] == ["Austin"]
    bad = {r["column"]: (r.n_rows, r.n_bad) for r in demographics_rejects(spark, path).collect()}
    assert bad["Median Age"] == (2, 1) and sum(n for _, n in bad.values()) == 1
    with pytest.raises(Exception, match="malformed double: abc"):
        read_demographics(spark, path, malformed="raise").collect()
    with pytest.raises(ValueError):
        read_demographics(spark, path, malformed="ignore")


def test_malformed_dates_are_counted(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "t.csv"), "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,"
                  "Latitude,Longitude\n2013-01-01,1.5,0.1,A,X,1N,1E\n2013-13-01,1.5,oops,A,X,1N,1E\n,,,B,X,1N,1E\n")
    bad = {r["column"]: r.n_bad for r in temperatures_rejects(spark, path).collect()}
    assert bad == {"dt": 1, "AverageTemperature": 0, "AverageTemperatureUncertainty": 1}


def test_plain_typed_read(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "plain.csv"), "a,b\n1,x\n,y\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert [tuple(r) for r in read_delimited(spark, path, schema).collect()] == [(1, "x"), (None, "y")]


def _write_lines(folder, lines, name="a.csv"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    return folder


def test_records_with_too_few_or_too_many_fields(spark, tmp_dir):
    from pyspark.sql import types as T
    from stellate.sources.files import broken_rows, count_broken, read_delimited

    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType()),
                           T.StructField("c", T.StringType())])
    path = _write_lines(os.path.join(tmp_dir, "x"), [
        "a;b;c", "x;1;y", "few;2", "many;3;y;z", '"q;uoted";4;"y;""z"', "last;5;", ";;", "many;6;y;", '"open;7;y'])
    counts = {r["defect"]: (r["n_rows"], r["n_bad"]) for r in count_broken(spark, path, schema, sep=";").collect()}
    assert counts == {"too_few_fields": (8, 2), "too_many_fields": (8, 2)}
    rows = broken_rows(spark, path, schema, sep=";").collect()
    assert sorted((r["defect"], r["n_fields"], r["record"]) for r in rows) == [
        ("too_few_fields", 1, '"open;7;y'), ("too_few_fields", 2, "few;2"),
        ("too_many_fields", 4, "many;3;y;z"), ("too_many_fields", 4, "many;6;y;")]
    assert all(r["file"].endswith("a.csv") for r in rows)
    kept = read_delimited(spark, path, schema, sep=";", broken="drop")
    assert sorted(r["b"] or 0 for r in kept.collect()) == [0, 1, 4, 5]
    assert kept.count() == 4 and kept.select("a").count() == 4  # whatever columns are used
    assert read_delimited(spark, path, schema, sep=";").count() == 8
    with pytest.raises(Exception, match="wrong number of fields"):
        read_delimited(spark, path, schema, sep=";", broken="raise").select("a").collect()
    with pytest.raises(ValueError):
        read_delimited(spark, path, schema, broken="no")


def test_footers_against_the_declared_schema(spark, tmp_dir):
    from stellate import schemas
    from stellate.sources import driver_tables
    from stellate.sources.files import SchemaError, check_schema, read_arrivals, schema_problems

    path = os.path.join(tmp_dir, "sas_data")
    a = driver_tables.arrivals(spark, "/root/testdata/sf0.001")
    a.coalesce(1).write.parquet(f"{path}/month=1")
    assert schema_problems(spark, path).count() == 0
    assert read_arrivals(spark, path, check=True).columns[:28] == schemas.ARRIVALS.fieldNames()
    # The next delivery renames one column, drops one and changes one's type.
    (a.withColumnRenamed("i94port", "port").drop("gender").withColumn("biryear", a["biryear"].cast("int"))
     .coalesce(1).write.parquet(f"{path}/month=2"))
    found = {(r["column"], r["problem"], r["found"]) for r in schema_problems(spark, path).collect()}
    assert found == {("i94port", "missing", None), ("gender", "missing", None), ("port", "undeclared", "string"),
                     ("biryear", "type", "int")}
    with pytest.raises(SchemaError, match="i94port.*month=2"):
        check_schema(spark, path)
