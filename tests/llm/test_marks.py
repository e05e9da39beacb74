"""Thresholds follow one rule at any number of rows."""

import numpy as np

from tillroll.llm import toxicity


def test_marks_do_not_jump_with_the_number_of_rows(monkeypatch):
    """One toxic row more or less outside the sample moves no threshold far, nor does one in a language."""
    rng = np.random.default_rng(2)
    # models fitted without their rows score lower than the rows outside the sample
    monkeypatch.setattr(toxicity, "cross_fitted", lambda docs, labels, model: np.where(labels == 1, -1.0, -6.0) + rng.normal(0, 0.1, len(labels)))
    labels = np.repeat([1, 0], [300, 400])
    sample = ([np.zeros((1, 4), np.int32)] * 700, labels, np.zeros(700, int))

    def found(toxic: int, own: int) -> np.ndarray:
        rows = np.zeros((toxicity.OTHER + 1, 2, 2 * toxicity.MOST * toxicity.CELLS + 1))
        np.add.at(rows, (0, 1, toxicity.cell(np.linspace(4, 6, toxic))), 1)
        np.add.at(rows, (0, 0, toxicity.cell(np.linspace(0, 2, 2000))), 1)
        np.add.at(rows, (1, 1, toxicity.cell(np.full(own, 9.0))), 1)
        np.add.at(rows, (1, 0, toxicity.cell(np.linspace(0, 8, 40))), 1)
        return toxicity.marks(rows, np.array([400, 300]), sample, None)

    assert abs(found(299, 0) - found(300, 0)).max() < 0.1  # the sample has 300 toxic rows
    assert abs(found(4000, 9) - found(4000, 10)).max() < 0.5
