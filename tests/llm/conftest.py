import pytest

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
# Names that the operators use inside, and names that differ by case alone.
CLASHING = ("fp", "sha", "size", "target", "copies", "component_id", "score", "TEXT", "Doc_Id", "c0", "_perhaps")


@pytest.fixture
def docs(spark):
    """Documents of (doc_id, text), or with lang and source too."""

    def make(*rows):
        whole = [(*row, *(None,) * (5 - len(row))) for row in rows]
        return spark.createDataFrame(whole, SCHEMA)

    return make


@pytest.fixture
def clashing():
    """The rows with further columns whose names clash with those that operators use."""

    def add(rows):
        names = [*rows.columns, *CLASHING]
        more = rows.rdd.map(lambda row: (*row, *(f"x{i}" for i in range(len(CLASHING)))))
        kinds = [f.dataType.simpleString() for f in rows.schema] + ["string"] * len(CLASHING)
        numbered = ", ".join(f"c{i} {kind}" for i, kind in enumerate(kinds))
        return rows.sparkSession.createDataFrame(more, numbered).toDF(*names)

    return add


@pytest.fixture
def rows_of():
    def rows(frame):
        return sorted((tuple(row) for row in frame.collect()), key=repr)

    return rows
