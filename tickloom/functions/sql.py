"""The two series functions for SQL text.

They are SQL functions, so Spark sees through them and no Python worker runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tickloom.functions import fixed


def register_sql_functions(spark: SparkSession, seed: int = 42) -> None:
    """UDF1 `to_delta(values, instrument)` and UDF2 `create_tests(ts_start, values, length, ntests)`.

    `create_tests(series, ts_start, vals, length, ntests)` gives windows in the order of a seeded
    hash of series and position, at most as many as there are, with starts counted in minutes from
    the series start. `series` names the series, `instrument:column:week`: then the windows are those
    that `windows_of` samples, and two series of a week differ. `test_windows` gives the same as a
    table, for use behind LATERAL.
    """
    cases = " ".join(
        f"WHEN '{name}' THEN {scale}D" for name, scale in fixed.INSTRUMENT_SCALE.items()
    )
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION to_delta(ts ARRAY<DOUBLE>, instrument STRING)
        RETURNS ARRAY<DOUBLE>
        RETURN transform(
            ts, x -> (x - coalesce(get(ts, 0), get(filter(ts, y -> y IS NOT NULL), 0))) * CASE instrument {cases} ELSE {fixed.DEFAULT_SCALE}D END)
        """
    )
    windows = f"""transform(
            slice(
                sort_array(transform(
                    CASE WHEN size(vals) > length
                        THEN sequence(0, size(vals) - length - 1) ELSE CAST(array() AS ARRAY<INT>) END,
                    i -> named_struct('h', md5(concat_ws(':', '{seed}', series, CAST(i AS STRING))), 'i', i))),
                1, ntests),
            r -> named_struct(
                'start_index', r.i,
                'ts_start', ts_start + make_dt_interval(0, 0, r.i),
                'target', slice(vals, r.i + 1, length)))"""
    given = "series STRING, ts_start TIMESTAMP_NTZ, vals ARRAY<DOUBLE>, length INT, ntests INT"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION create_tests({given})
        RETURNS ARRAY<STRUCT<start_index: INT, ts_start: TIMESTAMP_NTZ, target: ARRAY<DOUBLE>>>
        RETURN {windows}
        """
    )
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION test_windows({given})
        RETURNS TABLE (start_index INT, ts_start TIMESTAMP_NTZ, target ARRAY<DOUBLE>)
        RETURN SELECT w.start_index, w.ts_start, w.target FROM LATERAL explode({windows}) AS t(w)
        """
    )
