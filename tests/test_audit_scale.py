"""The audit moves its records as seldom as it can."""

from tidegrid.catalog import QUERIES, cleaning_queries, source_queries, tables
from tidegrid.operators import cleaning

SF = "/root/testdata/sf0.001"


def test_report_tables_audit_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)
    audited = source_queries.audited

    def counted(*args):
        def task(batches):
            for batch in batches:
                read.add(len(batch))
                yield batch

        out = audited(*args)
        return out.mapInArrow(task, out.schema)

    monkeypatch.setattr(source_queries, "audited", counted)
    rows = QUERIES["report_tables"](spark, SF).collect()
    assert len(rows) == 60
    assert read.value == audited(spark, SF).count()


def test_prefiltered_audit_works_its_records_out_once(spark, monkeypatch):
    trips = tables.trips(spark, SF)
    read = spark.sparkContext.accumulator(0)

    def task(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    def rows(fits):
        monkeypatch.setattr(cleaning, "fits_broadcast", lambda df: fits)
        df = trips.mapInArrow(task, trips.schema)
        out = cleaning.audit(df, cleaning_queries.trip_rules(), cleaning_queries.KEYS, cleaning_queries.ORDER, by=["taxi_type"], prefilter=True)
        return sorted(map(repr, out.collect()))

    in_place = rows(True)
    assert read.value == trips.count()
    assert rows(False) == in_place
