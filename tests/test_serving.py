import pytest

from stintlab.plans.serving import DEFAULT_SQL, read_only_sql, refused
from tests.conftest import rows


@pytest.fixture(scope="module", autouse=True)
def view(spark):
    spark.sql(
        "SELECT * FROM values ('SOFT', true, 1, 3), ('HARD', false, 2, 4) "
        "AS t(compound, clean_lap, created_at, x)"
    ).createOrReplaceTempView("lap_features")
    spark.range(3).selectExpr("id AS x").createOrReplaceTempView("secret")
    spark.udf.register("of_others", lambda x: x, "long")


@pytest.mark.parametrize(
    "text",
    [
        DEFAULT_SQL + ";",
        "SELECT created_at, 'drop table x; delete' AS said FROM lap_features",
        "WITH a AS (SELECT * FROM lap_features) SELECT * FROM a UNION ALL SELECT * FROM a",
        "SELECT * FROM lap_features WHERE x IN (SELECT max(x) FROM lap_features)",
        "SELECT compound, rank() OVER (ORDER BY x) FROM lap_features ORDER BY 1 LIMIT 3",
        "SELECT compound, count(*) FROM lap_features GROUP BY ROLLUP (compound) HAVING count(*) > 0",
        "SELECT * FROM lap_features l JOIN lap_features r USING (compound)",
        "SELECT * FROM lap_features LATERAL VIEW explode(array(1, 2)) e AS y",
        "SELECT * FROM lap_features PIVOT (sum(x) FOR compound IN ('SOFT'))",
        "SELECT compound FROM lap_features EXCEPT SELECT 'SOFT'",
        "VALUES (1), (2)",
        "SELECT * FROM range(3)",
        "WITH RECURSIVE n(i) AS (SELECT 1 UNION ALL SELECT i + 1 FROM n WHERE i < 5) SELECT sum(i) FROM n",
        "WITH a AS (SELECT 1 AS x), b AS (SELECT x + 1 AS y FROM a) SELECT y FROM b",
        "WITH a AS (WITH b AS (SELECT x FROM lap_features) SELECT * FROM b) SELECT * FROM a",
        "SELECT * FROM lap_features l, LATERAL (SELECT max(x) FROM lap_features r WHERE r.x >= l.x)",
        "SELECT CASE WHEN x > 3 THEN 'a' ELSE upper(compound) END, x BETWEEN 1 AND 2, cast(x AS double) FROM lap_features",
        "SELECT extract(YEAR FROM current_date), date_part('month', DATE'2024-05-06'), current_timestamp() FROM lap_features",
        "SELECT compound, grouping(compound), string_agg(compound, ','), approx_percentile(x, 0.5) FROM lap_features GROUP BY CUBE (compound)",
        "SELECT aggregate(array(1, 2), 0, (a, b) -> a + b), exists(array(1), v -> v > x), md5(compound), sha2(compound, 256) FROM lap_features",
        "SELECT get_json_object('{\"a\": 1}', '$.a'), from_json('{\"a\": 1}', 'a INT').a, typeof(x) FROM lap_features",
        "FROM lap_features |> WHERE x > 3 |> SELECT compound, x |> ORDER BY x",
        "FROM lap_features |> AGGREGATE sum(x) AS total GROUP BY compound",
        "SELECT x, sum(x) OVER (PARTITION BY compound) FROM lap_features",
        "SELECT stack(2, 1, 2), levenshtein(compound, 'SAFT'), soundex(compound), make_date(2024, 1, 2), bin(x) FROM lap_features",
        "SELECT * FROM lap_features l JOIN lap_features r ON l.x < r.x",
    ],
)
def test_reads_are_run(spark, text):
    read_only_sql(spark, text).collect()


@pytest.mark.parametrize(
    "text",
    [
        "DROP VIEW lap_features",
        "WITH a AS (SELECT 1 AS x) INSERT INTO lap_features SELECT * FROM a",
        "CREATE TABLE t AS SELECT * FROM lap_features",
        "CREATE OR REPLACE TEMP VIEW lap_features AS SELECT 1",
        "ALTER TABLE lap_features RENAME TO other",
        "UPDATE lap_features SET x = 1",
        "DELETE FROM lap_features",
        "TRUNCATE TABLE lap_features",
        "INSERT OVERWRITE DIRECTORY '/tmp/x' USING parquet SELECT 1",
        "SET spark.sql.ansi.enabled = false",
        "CALL something()",
        "CACHE TABLE lap_features",
        "ADD JAR '/tmp/x.jar'",
        "EXECUTE IMMEDIATE 'SELECT 1'",
        "BEGIN SELECT 1; END",
        "SELECT * FROM parquet.`/tmp/x`",
        "SELECT * FROM lap_features WHERE x = (SELECT max(x) FROM json.`/tmp/x`)",
        "SELECT EXISTS (SELECT 1 FROM csv.`/etc/passwd`) FROM lap_features",
        "SELECT * FROM lap_features WHERE x IN (SELECT x FROM secrets)",
        "SELECT * FROM other_db.lap_features",
        "SELECT reflect('java.lang.System', 'exit', 1) FROM lap_features",
        "SELECT TRANSFORM (compound) USING 'cat' FROM lap_features",
        "SELECT identifier('reflect')('java.lang.System', 'getProperty', 'java.version')",
        "SELECT identifier('ref' || 'lect')('java.lang.System', 'getProperty', 'java.version') FROM lap_features",
        "SELECT `reflect`('java.lang.System', 'getProperty', 'java.version') FROM lap_features",
        "SELECT system.builtin.reflect('java.lang.System', 'getProperty', 'java.version')",
        "SELECT * FROM lap_features WHERE x = (SELECT identifier('java_method')('java.lang.Math', 'abs', -1))",
        "SELECT identifier('x') FROM lap_features",
        "SELECT * FROM identifier('secret')",
        "WITH secret AS (SELECT * FROM secret) SELECT * FROM secret",
        "WITH a AS (WITH secret AS (SELECT * FROM secret) SELECT * FROM secret) SELECT * FROM a",
        "SELECT (WITH secret AS (SELECT * FROM secret) SELECT max(x) FROM secret) FROM lap_features",
        "WITH a AS (SELECT * FROM b), b AS (SELECT 1 AS x) SELECT * FROM a",
        "SELECT * FROM lap_features l, LATERAL (SELECT max(x) FROM secret)",
        "SELECT * FROM lap_features LATERAL VIEW explode(array(java_method('java.lang.Math', 'abs', -1))) e AS y",
        "SELECT * FROM secret",
        "SELECT version()",
        "SELECT try_reflect('java.lang.System', 'getProperty', 'java.version') FROM lap_features",
        "SELECT java_method('java.lang.Math', 'abs', -1)",
        "SELECT input_file_name(), input_file_block_start() FROM lap_features",
        "SELECT current_user(), current_catalog() FROM lap_features",
        "SELECT raise_error('stop') FROM lap_features",
        "SELECT monotonically_increasing_id() FROM lap_features",
        "SELECT from_protobuf(x, 'A', '/etc/passwd') FROM lap_features",
        "SELECT no_such_function(x) FROM lap_features",
        "SELECT of_others(x) FROM lap_features",
        "SELECT * FROM read_files('/etc')",
        "SELECT sum(id) FROM range(1000000000000)",
        "SELECT count(*) FROM range(50000000) a, range(50000000) b",
    ],
)
def test_all_else_is_refused(spark, text):
    assert refused(spark, text)
    assert len(rows(spark.table("lap_features"))) == 2


def test_invalid_recursion_never_reaches_the_view(spark):
    with pytest.raises(Exception, match="INVALID_RECURSIVE_CTE|read-only|known views"):
        read_only_sql(spark, "WITH RECURSIVE secret AS (SELECT * FROM secret) SELECT * FROM secret").collect()
