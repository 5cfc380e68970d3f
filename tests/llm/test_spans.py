"""Cells with odd ``colspan`` values."""

import pytest

from tablework.llm.html_layout import _span, render


@pytest.mark.parametrize("value, columns", [
    (None, 1), ("", 1), ("0", 1), ("000", 1), ("2", 2), ("0003", 3), ("1000", 1000), ("1001", 1000), ("9" * 5000, 1000),
    ("²", 1), ("٣", 1), ("-1", 1), ("2x", 1)])
def test_span(value, columns):
    assert _span(value) == columns


@pytest.mark.parametrize("value", ["²", "9" * 5000])
def test_a_page_with_an_odd_span_is_rendered(value):
    assert render(f"<table><tr><td colspan={value}>a<td>b</table>").split() == ["a", "b"]
