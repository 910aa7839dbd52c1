import pytest

from floodplan.functions.checks import check_rise, check_window


def test_rise():
    assert [check_rise(v) for v in (0, "5", "05", 8848)] == [0, 5, 5, 8848]
    assert check_rise("95", 95) == 95
    for bad in (-1, 8849, "x", "1.5", None, True, "", "1_0", "+7", " 5 ", "5\n", "\u0665"):
        with pytest.raises(ValueError):
            check_rise(bad)
    with pytest.raises(ValueError):
        check_rise(96, 95)


def test_window():
    assert check_window("2") == 2
    for bad in (0, -1, "x", 1.5, None):
        with pytest.raises(ValueError):
            check_window(bad)
