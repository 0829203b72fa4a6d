"""Read a physical plan the way a user does: the text of ``explain``."""

from __future__ import annotations

import contextlib
import io


def plan_text(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
