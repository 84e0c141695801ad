from millrace.plans import taxi
from millrace.session import fresh_name
from millrace.sources import tables

HEADER = (
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,RatecodeID,"
    "store_and_fwd_flag,PULocationID,DOLocationID,payment_type,fare_amount,extra,mta_tax,tip_amount,"
    "tolls_amount,improvement_surcharge,total_amount,congestion_surcharge,airport_fee"
)


def trip(vendor, pickup, fare, tip="0.5", payment="1", location="7"):
    return f"{vendor},{pickup},{pickup},1.0,2.0,9.0,N,{location},8,{payment},{fare},0.5,0.5,{tip},0.0,0.3,{fare},2.5,"


def test_csv_to_silver_to_reports(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "\n".join([HEADER, trip(1, "2022-01-01 00:10:00", "10.5"), trip(2, "2022-01-01 00:50:00", "20.5", payment="6")]) + "\n"
    )
    (folder / "b.csv").write_text(
        "\n".join(
            [
                HEADER,
                trip(1, "2022-01-01 02:10:00", "30.5", payment="3"),
                trip(1, "2019-01-01 02:10:00", "40.5"),
                trip(1, "2022-01-01 02:10:00", "-5.5"),
                trip("", "2021-12-31 23:10:00", "1.5", tip=""),
            ]
        )
        + "\n"
    )
    names = {"bronze": fresh_name("bronze"), "silver": fresh_name("silver")}
    for _ in range(2):
        trips = taxi.build_tables(spark, str(folder / "a.csv"), str(folder), str(tmp_path / "tables"), **names)
        assert spark.table(names["bronze"]).count() == 6
        assert trips.count() == 3 == spark.table(names["silver"]).count()
    assert tables.files_needed(spark, tables.table_location(spark, names["silver"])) == 1
    assert sorted((r.vendor_id, r.payment_type, r.rate_code_id) for r in trips.collect()) == [
        ("CMTech", "No_Charge", "Group_Ride"),
        ("CMTech", "credit", "Group_Ride"),
        ("Verifone", "Voided_Trip", "Group_Ride"),
    ]
    revenue = {r.vendor_id: r.total_revenue for r in taxi.revenue_by_vendor(trips).collect()}
    assert revenue == {"CMTech": 41.0, "Verifone": 20.5}
    assert [tuple(r) for r in taxi.median_fare_per_mile(trips).collect()] == [("2022-01", 7, 10.25)]
    assert taxi.revenue_forecast(trips, hours=24).count() == 2 + 24


def test_odd_values_in_known_columns_become_null(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "0.csv").write_text(HEADER + "\n")
    (folder / "a.csv").write_text(
        "\n".join([HEADER, trip(1, "2022-01-01 00:10:00", "10.5"), trip("one", "2022-01-01 00:50:00", "20.5"), trip(2, "2022-01-01 00:50:00", "free")]) + "\n"
    )
    names = {"bronze": fresh_name("bronze"), "silver": fresh_name("silver")}
    trips = taxi.build_tables(spark, str(folder), str(folder), str(tmp_path / "tables"), **names)
    assert sorted((r.vendor_id, r.fare_amount) for r in trips.collect()) == [("CMTech", 10.5), ("Verifone", 20.5)]
    losses = taxi.trip_losses(spark.table(names["bronze"])).first().asDict()
    assert losses == {"VendorID": 1, "fare_amount": 1, "total_amount": 1, "airport_fee": 0}
