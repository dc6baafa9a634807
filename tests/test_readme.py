"""The example of the README on the smallest given tables."""

from pathlib import Path


def test_example_reads_the_given_tables(spark):
    example = (Path(__file__).resolve().parents[1] / "README.md").read_text().split("```python\n")[1].split("```")[0]
    assert "generate" not in example
    names = {"spark": spark}
    exec(example, names)
    assert not names["prepared"].examples.isEmpty()
