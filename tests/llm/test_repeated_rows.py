"""Rows equal in id and text cost ops 1, 3 and 10 one packed or verified text, not one for each pair of rows."""

from collections import Counter

import pytest

from medallion.llm import _repeats, jaccard, substrings, suffixes
from tests.llm.test_operators import W, text

#: Around a shared passage: other contents at the same anchors.
OTHERS = [(1, "a " + text(0, 80) + " b"), (2, "c " + text(0, 80, w70="x")), (3, text(10, 90))]


def rows(spark, copies):
    return spark.createDataFrame([(None, " ".join(W[:100]))] * copies + OTHERS, "doc_id long, text string")


@pytest.fixture()
def counts(monkeypatch):
    out = Counter()
    for module in (_repeats, jaccard):
        def counted(df, name, plain=module.written):
            done = plain(df, name)
            out[name] += done.count()
            return done

        monkeypatch.setattr(module, "written", counted)
    return out


@pytest.mark.parametrize("remove", [suffixes.remove_repeats, substrings.remove_repeats])
def test_repeated_rows_pack_once(spark, counts, remove):
    few = Counter(map(str, remove(rows(spark, 2), ["doc_id"]).collect()))
    packed = counts.pop("packed-windows")
    many = Counter(map(str, remove(rows(spark, 20), ["doc_id"]).collect()))
    assert packed and counts["packed-windows"] == packed
    assert set(many) == set(few) and sorted(many.values()) == [1, 1, 1, 20]


def test_repeated_rows_verify_once(spark, counts):
    out = jaccard.near_duplicates(rows(spark, 20)).collect()
    assert len(out) == 23 and {r.component_id for r in out if r.doc_id is None} == {1}
    assert counts["meeting-texts"] <= 4
