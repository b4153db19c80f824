from tillhouse.plans.lazy import LazyDict, merged
from tillhouse.session import shuffle_partitions_for


def test_shuffle_partitions_for():
    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(256 << 20) == 8
    assert shuffle_partitions_for(10 << 40) == 40 * 1024
    assert shuffle_partitions_for(100 << 40) == 400 * 1024       # no cap: partitions never outgrow the target


def test_lazy_dict_builds_on_first_use_only():
    built = []
    d = LazyDict({"a": lambda: built.append("a") or 1, "b": lambda: built.append("b") or 2})
    assert "a" in d and len(d) == 2 and built == []
    assert d["a"] == 1 and d["a"] == 1 and built == ["a"]
    d["c"] = 3
    m = merged(d, {"b": 20})
    assert built == ["a"] and m["b"] == 20 and m["c"] == 3 and sorted(m) == ["a", "b", "c"]
