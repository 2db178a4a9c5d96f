import pytest

from tasteloom.sources.reviews import read_csv, read_reviews, write_csv
from tasteloom.sources.schemas import MissingColumns

HEADER = "Id,ProductId,UserId,Summary,Score,Time\n"


def test_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        HEADER + '1,p,u,"say ""hi"", ok",5,10\n2,q,v,"two\nlines",4,20\n3,r,w,plain,x,\n')
    rows = sorted(map(tuple, read_reviews(spark, str(tmp_path), multiline=True).collect()))
    assert rows == [(1, "u", "p", 5.0, 10), (2, "v", "q", 4.0, 20), (3, "w", "r", None, None)]


def test_splittable_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text(HEADER + '1,p,u,"say ""hi"", ok",5,10\n')
    assert [tuple(r) for r in read_reviews(spark, str(tmp_path)).collect()] == [(1, "u", "p", 5.0, 10)]


def test_missing_column_fails_at_once(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Id,UserId\n1,u\n")
    with pytest.raises(MissingColumns, match="ProductId"):
        read_reviews(spark, str(tmp_path))


def test_round_trip_of_awkward_text(spark, tmp_path):
    # An empty field is read as NULL, as by any Spark CSV reader.
    rows = [(1, 'a "b", c'), (2, "x\ny"), (3, None), (4, "a\r\nb\n"), (5, "\\"), (6, '"'), (7, " pad ")]
    df = spark.createDataFrame(rows, "i long, t string")
    for _ in range(2):
        write_csv(df, str(tmp_path / "out"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "out"), df.schema, multiline=True).collect())) == rows
