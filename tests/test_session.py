from floodplan.session import delete_folder


def test_a_settled_folder_is_deleted_and_no_other(spark, tmp_path):
    for name in ("mine", "other"):
        spark.range(3).write.parquet(f"{tmp_path}/{name}/table")
    assert delete_folder(spark, f"{tmp_path}/mine")
    assert not (tmp_path / "mine").exists()
    assert spark.read.parquet(f"{tmp_path}/other/table").count() == 3
    assert not delete_folder(spark, f"{tmp_path}/mine")
