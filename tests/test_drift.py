"""Fields of a message are written once, and drift counts messages."""

from waypost.catalog import standin as S
from waypost.operators.validation import field_drift
from waypost.schemas import RECORD_COLUMNS

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fields_of_a_message_are_written_once(spark):
    for corrupt in (False, True):
        assert plan(S.messages(spark, SF, corrupt)).count("cast(velocity") == 1


def test_drift_counts_messages(spark):
    full = ", ".join(f'"{c}": 1' for c in RECORD_COLUMNS)
    less = ", ".join(f'"{c}": 1' for c in RECORD_COLUMNS if c != "region")
    texts = [f"{{{full}}}"] * 3 + [f"{{{less}}}"] * 2 + [f'{{"speed": 1, "speed": 2, {less}}}', "{broken", "[]", None]
    found = field_drift(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sorted(map(tuple, found.collect())) == [("region", "missing", 3), ("speed", "unexpected", 1)]
    assert field_drift(spark.createDataFrame([], "value string")).collect() == []
