"""Time windows and thresholds shared by features, reports and the model."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Windows:
    """A label window ``[l_start, l_end]`` with history strictly before it.

    ``redeem_days``: a receipt counts as redeemed (T5, ``rec_used``) when it
    was used at most this many days after it was received.
    ``rule_cut``: the published label rule, ``discount <= rule_cut`` (T6).
    """

    l_start: dt.date = dt.date(2016, 7, 1)
    l_end: dt.date = dt.date(2016, 7, 31)
    redeem_days: int = 15
    rule_cut: float = 0.8

    @property
    def cutoff(self) -> dt.date:
        return self.l_start


# Scoring: July 2016, history before it. Training: 31 days ending two
# weeks before the scoring cutoff, so every training label can mature
# (15 days) before the scoring history ends.
SCORING = Windows()
TRAINING = Windows(l_start=dt.date(2016, 5, 16), l_end=dt.date(2016, 6, 15))
