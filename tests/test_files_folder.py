import pytest

from pageloom.plans import files as P
from pageloom.sources import readers as R
from pageloom.sources import writers as W

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["box_csv", "mask_csv", "mask_file_regions", "words_json_files"])
def test_a_folder_is_listed_as_one(spark, name):
    # A glob would hand every file to the driver as a path of its own.
    plan = P.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and plan.count("FileScan text") <= 2 * plan.count("InMemoryFileIndex(1 paths)")


def test_packed_files_are_read_as_they_were(spark, tmp_path):
    text = '[{"word":"aé"}]' * 50
    d = spark.createDataFrame([("p-1.json.gz", text), ("p-2.json", text)], "name string, content string")
    assert W.write_files(d, str(tmp_path)).where("ok").count() == 2
    assert (tmp_path / "p-1.json.gz").stat().st_size < (tmp_path / "p-2.json").stat().st_size / 4
    got = {r["file"].rsplit("/", 1)[1]: r["line"] for r in R.read_lines(spark, str(tmp_path)).collect()}
    assert got == {"p-1.json.gz": text, "p-2.json": text}
