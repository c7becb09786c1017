import os

from stellate import cli
from stellate.sinks.files import write_csv, write_parquet
from stellate.sinks.snapshots import read_table
from stellate.sources import driver_tables as A

from conftest import SMOKE_DIR


def test_cli_load_from_files(spark, tmp_dir):
    """The file layout of the original load, derived from the sf0.001 tables."""
    inp = os.path.join(tmp_dir, "input")
    write_parquet(A.arrivals(spark, SMOKE_DIR), f"{inp}/sas_data")
    write_csv(A.demographics(spark, SMOKE_DIR), f"{inp}/us-cities-demographics.csv", sep=";")
    write_csv(A.temperatures(spark, SMOKE_DIR), f"{inp}/GlobalLandTemperaturesByCity.csv")
    write_csv(A.country_lookup(spark, SMOKE_DIR), f"{inp}/country_mapping.csv", single_file=True)
    states = spark.createDataFrame([("TX", "TEXAS"), ("99", "All Other Codes ")],
                                   "state_code string, state string")
    ports = spark.createDataFrame([("ALC", "ALCAN, AK"), ("   AG", "=")],
                                  "port_code string, port_name string")
    write_csv(states, f"{inp}/state_code_dim.csv", single_file=True)
    write_csv(ports, f"{inp}/port_code.csv", single_file=True)
    out = os.path.join(tmp_dir, "out")
    assert cli.main(["load", "--input", inp, "--output", out,
                     "--calendar-null-dates", "drop"]) == 0
    report = spark.read.parquet(f"{out}/_quality_report").collect()
    assert len(report) == 10 and all(r.passed for r in report)
    assert read_table(spark, out, "dim_port").where("port_code = 'AG'").count() == 1
    assert read_table(spark, out, "dim_us_state").where("state = 'All Other Codes'").count() == 1
    plain = os.path.join(tmp_dir, "plain")
    assert cli.main(["export", "--input", out, "--output", plain]) == 0
    assert spark.read.parquet(f"{plain}/dim_port").where("port_code = 'AG'").count() == 1
    assert spark.read.parquet(f"{plain}/fact_immigration").count() == read_table(spark, out, "fact_immigration").count()
    star = os.path.join(tmp_dir, "star")
    assert cli.main(["refresh", "--input", f"{inp}/sas_data", "--output", star]) == 0
    assert read_table(spark, star, "dim_immigrant").count() == read_table(spark, out, "dim_immigrant").count()
    prof = os.path.join(tmp_dir, "prof")
    assert cli.main(["profile", "--input", f"{inp}/sas_data", "--output", prof]) == 0
    assert spark.read.option("header", True).csv(f"{prof}/arrivals_summary").count() == 8
