import numpy as np
import pytest

from helpers import ROW0, ROW1, credit_frame
from pyspark.sql import functions as F

from riskweft.operators import features as fe, neighbours as nn, prep as pp


def test_mixed_types(spark):
    train = spark.createDataFrame(
        [(1, 100.0, "F", 0), (2, None, "M", 1), (3, 300.0, "F", 2), (4, 200.0, None, 0)], "ID int, LIMIT_BAL double, SEX string, PAY_0 int"
    )
    validation = spark.createDataFrame([(5, None, "X", 1), (6, 150.0, "M", 0)], "ID int, LIMIT_BAL double, SEX string, PAY_0 int")
    prep = pp.fit_preparation(train, keep=())
    assert prep.dropped_columns == ("ID",) and prep.output_columns == ["LIMIT_BAL", "PAY_0", "SEX_F", "SEX_M"]
    assert prep.numeric["LIMIT_BAL"].median == 200.0 and prep.categories["SEX"].mode == "F"
    out = pp.transform(prep, validation, ())
    assert out.columns == pp.transform(prep, train, ()).columns
    unseen, known = out.collect()
    assert (unseen["SEX_F"], unseen["SEX_M"]) == (0.0, 0.0) and known["SEX_M"] == 1.0 and unseen["LIMIT_BAL"] == 0.0
    x = np.array([100.0, 200.0, 300.0, 200.0])
    assert known["LIMIT_BAL"] == pytest.approx((150 - x.mean()) / x.std())


def test_contract_categories(spark):
    train = fe.engineer_features(credit_frame(spark, [ROW0, ROW1, ROW0]))
    prep = pp.fit_preparation(train, keep=("row_id",))
    assert prep.categorical_columns == ("X2", "X3", "X4") and "bill_mean" in prep.engineered_columns
    other = list(ROW0)
    other[2] = 9
    out = pp.transform(prep, fe.engineer_features(credit_frame(spark, [other])), ("row_id",))
    assert not any(c.startswith("X3_9") for c in out.columns) and out.first()["X3_2.0"] == 0.0


def test_constant_column_and_quotes(spark):
    df = spark.createDataFrame([(1.0, "it's"), (1.0, "b\\c")], "k double, t string")
    prep = pp.fit_preparation(df, keep=())
    rows = pp.transform(prep, df, ()).collect()
    assert rows[0]["k"] == 0.0 and rows[0]["t_it's"] == 1.0 and rows[1]["t_b\\c"] == 1.0


def brute(vectors, labels, rank):
    opposite = 0
    for i in range(len(vectors)):
        order = sorted((float(np.sqrt(((vectors[j] - vectors[i]) ** 2).sum())), j) for j in range(len(vectors)) if j != i)
        opposite += labels[order[rank - 1][1]] != labels[i]
    return opposite


@pytest.mark.parametrize("rank", [1, 2])
@pytest.mark.parametrize("pivots,chunk", [(1, 1000), (6, 5)])
def test_neighbours_by_brute_force(spark, rank, pivots, chunk):
    rng = np.random.default_rng(5)
    vectors = rng.integers(0, 4, size=(60, 3)).astype(float)  # many ties and copies
    vectors[:20] = vectors[0]  # a third of the rows are copies of one row
    labels = [int(x) for x in rng.integers(0, 2, 60)]
    df = spark.createDataFrame([(i, labels[i], [float(x) for x in vectors[i]]) for i in range(60)], "row_id bigint, Y int, vec array<double>")
    row = nn.opposite_label_rate(df, "row_id", "Y", "vec", rank, chunk=chunk, pivots=pivots).first()
    assert row["rows"] == 60 and row["opposite"] == brute(vectors, labels, rank)


def test_vectors_are_not_copied_for_each_cell_they_visit(spark, monkeypatch):
    """In many dimensions every vector looks at every cell; it was written once for each."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(300, 24))
    labels = [int(x) for x in rng.integers(0, 2, 300)]
    df = spark.createDataFrame([(i, labels[i], [float(x) for x in vectors[i]]) for i in range(300)], "row_id bigint, Y int, vec array<double>")
    kept, written = nn.stage, []

    def counted(table, label):
        out = kept(table, label)
        if "vec" in out.columns:
            written.append(out.agg(F.sum("n") if "n" in out.columns else F.count(F.lit(1))).first()[0])
        return out

    monkeypatch.setattr(nn, "stage", counted)
    monkeypatch.setattr(nn, "PART_BYTES", 5_000)
    row = nn.opposite_label_rate(df, "row_id", "Y", "vec", 2, chunk=7, pivots=12).first()
    assert row["rows"] == 300 and row["opposite"] == brute(vectors, labels, 2)
    assert max(written) == 300


def test_standardised_constant_column(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 5.0)], "row_id bigint, a double, b double")
    got = [r["vec"] for r in nn.standardized_vectors(df, ["a", "b"], ["row_id"]).orderBy("row_id").collect()]
    assert got[0][0] == pytest.approx(-(0.5 ** 0.5)) and got[0][1] == got[1][1] == 0.0
