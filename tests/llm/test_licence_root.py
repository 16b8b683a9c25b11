"""Operator 6: a licence file at the root counts for the whole tree."""

from orderlake.llm import licences


def test_root_licence_is_inherited(spark):
    files = spark.createDataFrame([
        (1, "LICENSE", "Released under the MIT License."), (2, "src/x.py", "code"), (3, "src/deep/y.py", "more code"),
        (4, "lib/LICENSE", "Licensed under CC BY 4.0."), (5, "lib/z.py", "code"), (6, "top.py", "code"),
        (7, None, None)], "file_id long, path string, text string")
    found = {r["file_id"]: (r["licence"], r["how"], r["from_dir"]) for r in licences.scan(files).collect()}
    assert found == {1: ("MIT", "file", None), 2: ("MIT", "inherited", ""), 3: ("MIT", "inherited", ""),
                     4: ("CC-BY-4.0", "file", None), 5: ("CC-BY-4.0", "inherited", "lib"), 6: ("MIT", "inherited", ""),
                     7: ("MIT", "inherited", "")}
