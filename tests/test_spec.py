"""What a run may be asked to do, and where it resumes (no Spark needed)."""

import itertools

import pytest

from sluice.plans.state import resume_at, with_mark
from sluice.sources.scan import Watermark
from sluice.spec import DEFAULT_BATCH_ROWS, LEGAL, SyncSpec, is_interval, is_path, is_table_name, name_parts

FULL = dict(keys=["k"], hwm_col="changed", change_log="/feed", outbox="/out")


def complete(capture, mode):
    return SyncSpec("shop.sales", "sales_copy", capture=capture, mode=mode, **FULL)


@pytest.mark.parametrize("capture, mode", list(itertools.product(("none", "hwm", "stream"), ("truncate", "append", "upsert"))))
def test_every_pair_is_legal_or_refused(capture, mode):
    found = complete(capture, mode).problems()
    assert bool(found) == ((capture, mode) not in LEGAL)


@pytest.mark.parametrize("pair", LEGAL)
def test_each_needed_option_is_missed(pair):
    for option in LEGAL[pair]:
        spec = complete(*pair)
        setattr(spec, option, [] if option == "keys" else None)
        assert [p.split(":")[0] for p in spec.problems()] == [option]


def test_all_problems_are_named_at_once():
    spec = SyncSpec("a b", "t", capture="later", staging="tape", outbox_retention_days=-3, keys=["1x"])
    assert sorted(p.split(":")[0] for p in spec.problems()) == [
        "capture", "keys", "outbox_retention_days", "source", "staging"]
    with pytest.raises(ValueError, match="later.*tape"):
        spec.checked()


@pytest.mark.parametrize("options, culprit", [
    (dict(staging="parquet", batch_rows=10), "batch_rows"), (dict(stage_path="/x"), "stage_path"),
    (dict(keep_files=True), "keep_files"), (dict(on_match="merge"), "on_match"),
    (dict(lookback="2 DAYS"), "lookback"), (dict(order_cols=["a;b"]), "order_cols")])
def test_options_out_of_place(options, culprit):
    assert [p.split(":")[0] for p in SyncSpec("s", "t", **options).problems()] == [culprit]


def test_defaults_are_filled_in():
    assert SyncSpec("s", "t").checked().batch_rows == DEFAULT_BATCH_ROWS
    assert SyncSpec("s", "t", staging="csv").checked().batch_rows is None


@pytest.mark.parametrize("name, parts", [
    ("t", ["t"]), ("a.b$1.c_", ["a", "b$1", "c_"]), ("`odd name`.t", ["odd name", "t"]), ("`x.y`", ["x.y"]),
    ("", None), ("a..b", None), ("a.", None), ("1a", None), ("`a", None), ("``", None), ("a`b`", None), ("é", None)])
def test_names(name, parts):
    assert name_parts(name) == parts and is_table_name(name) == (parts is not None)


def test_four_parts_are_too_many():
    assert not is_table_name("a.b.c.d")


def test_intervals_and_paths():
    assert is_interval("interval 15 Minutes") and is_interval("INTERVAL 1 DAY")
    assert not any(map(is_interval, ("INTERVAL 1 WEEK", "INTERVAL -1 DAY", "INTERVAL 1 DAY OR 1=1", "DAY")))
    assert is_path("hdfs://nn:8020/a-b/c=1") and not any(map(is_path, ("", "/a b", "/a;b", "/a'b")))


def test_marks_are_kept_by_source_and_target():
    five, nine = Watermark("bigint", "5"), Watermark("date", "2020-02-02")
    progress = with_mark({"other": 1}, "a", "t", five)
    progress = with_mark(with_mark(progress, "b", "t", nine), "a", "u", nine)
    assert (resume_at(progress, "a", "t"), resume_at(progress, "b", "t"), resume_at(progress, "b", "u")) == (five, nine, None)
    moved = with_mark(progress, "a", "t", nine)
    assert resume_at(moved, "a", "t") == nine and len(moved["marks"]) == 3 and moved["other"] == 1
