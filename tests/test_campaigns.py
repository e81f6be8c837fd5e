"""Campaign files that are one array over several lines: split anywhere, the records are those of a plain JSON reader."""

import json
import random

import pytest

from tidecast.plans.registry import QUERIES
from tidecast.sources.campaigns import Range, array_records, read_campaigns

FIELDS = ["campaign", "impressions", "clicks", "cost", "conversions", "date"]
NAMES = ['plain', 'a "quoted" name', 'brace } and { in', 'back\\slash', 'ends in \\', '], [', 'line\nend', 'ünï 日本', '', '\\"}']


@pytest.fixture
def split(spark):
    """Set how many bytes a task reads at most."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def campaigns(n, seed):
    rng = random.Random(seed)
    return [{"campaign": rng.choice(NAMES), "impressions": k, "clicks": rng.choice([None, 3]), "cost": k / 4, "conversions": 1, "date": "2022-02-09"}
            for k in range(n)]


def rows_of(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=repr)


def wanted(*lists):
    return sorted((tuple(r.get(f) for f in FIELDS) for records in lists for r in records), key=repr)


@pytest.mark.parametrize("size", [40, 150, 1000, 1 << 20])
def test_split_anywhere(spark, tmp_path, split, size):
    many, few = campaigns(60, 1), campaigns(3, 2)
    (tmp_path / "a.json").write_text(json.dumps(many, indent=2, ensure_ascii=False))
    (tmp_path / "b.json").write_text("[\n" + ",\n".join(json.dumps(r) for r in few) + "\n]\n")
    (tmp_path / "c.json").write_text("[\r\n" + ", ".join(json.dumps(r) for r in few) + ",\r\n" + json.dumps(few[0]) + "]")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "nothing.json").write_text(" [\n]\n")
    split(size)
    got = read_campaigns(spark, str(tmp_path), one_array_per_file=True)
    assert rows_of(got) == wanted(many, few, few, few[:1])
    tasks = spark.read.text(str(tmp_path / "a.json")).rdd.getNumPartitions()
    assert (tasks > 10) == (size < 1000), "the file is read by several tasks"


def test_missing_fields_and_repeats(spark, tmp_path, split):
    records = [{"campaign": "x"}, {}, {"campaign": "x"}, {"other": [1, 2], "date": "d"}]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=1))
    split(10)
    assert rows_of(read_campaigns(spark, str(tmp_path), one_array_per_file=True)) == wanted(records)


@pytest.mark.parametrize("text", [
    '[\n{"campaign": "a"},\n{"campaign": "b"', '[\n"campaign": "b"}\n]', '[\n{"campaign": {"x": 1}}\n]', '[\n{"campaign": "a},\n{"campaign": "b"}\n]', "no JSON\nat all",
    '[\n{"campaign": "a"},\n17,\n{"campaign": "b"}]', '[\n{"impressions": "many"}\n]', '[\n{"campaign" "a"}\n]',
])
@pytest.mark.parametrize("size", [12, 1 << 20])
def test_malformed(spark, tmp_path, split, text, size):
    (tmp_path / "a.json").write_text(text)
    split(size)
    with pytest.raises(Exception, match="(?i)malformed|cannot_parse"):
        read_campaigns(spark, str(tmp_path), one_array_per_file=True).collect()


def test_ranges_of_lines():
    """Cut at any line, a range gives its whole records, and what is left of two neighbours is the record between them."""
    records = campaigns(5, 3)
    lines = json.dumps(records, indent=1).split("\n")
    for cut in range(len(lines)):
        left, right = Range(), Range()
        found = [r for line in lines[:cut] for r in left.read(line)] + [r for line in lines[cut:] for r in right.read(line)]
        rest = Range()
        rest.known = True
        found += rest.read(" ".join([*left.head, *left.open, *right.head, *right.open]))
        assert sorted(map(json.dumps, map(json.loads, found))) == sorted(map(json.dumps, records)) and not rest.open


def test_registered_layout(spark):
    """Both layouts hold the same records, and no cell holds a file."""
    sf_dir = "/root/testdata/sf0.001"
    arrays, lines = (rows_of(QUERIES[name](spark, sf_dir)) for name in ("campaign_array_scan", "campaign_json_scan"))
    assert arrays == lines and arrays


def test_rows_are_small(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(campaigns(5000, 4), indent=2))
    assert array_records(spark, str(tmp_path)).selectExpr("max(length(records))").first()[0] < 70_000
