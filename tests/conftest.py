import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from opinlake.session import apply_lake_settings

    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("opinlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(work / "shared"))
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    apply_lake_settings(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_silver(spark):
    """Silver from (product_id, score, text, ...) dicts, enriched by the library."""
    from opinlake import schemas
    from opinlake.functions.review import enrich

    base = (
        "product_id string, user_id string, score int, text string, source string,"
        " review_id string, created_at timestamp"
    )
    names = [column.split()[0] for column in base.split(",")]
    origin = schemas.SILVER.fieldNames()[:5]

    def build(rows):
        from pyspark.sql import functions as F

        data = [tuple(row.get(name) for name in names) for row in rows]
        frame = enrich(spark.createDataFrame(data, base))
        types = {f.name: f.dataType for f in schemas.SILVER.fields}
        return frame.select(
            *(F.lit(None).cast(types[name]).alias(name) for name in origin), *frame.columns
        )

    return build
