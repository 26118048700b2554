"""Messages of a run on the driver: to the console, and to a file if one is named."""

from __future__ import annotations

import logging
from pathlib import Path


def configured(level: str = "INFO", file: str | Path | None = None) -> logging.Logger:
    """The library's logger at a level, with time, level and name on each line; called again, it replaces its former outputs."""
    log = logging.getLogger("voltmesh")
    log.setLevel(level.upper())
    for old in list(log.handlers):
        log.removeHandler(old)
        old.close()
    outputs: list[logging.Handler] = [logging.StreamHandler()]
    if file is not None:
        Path(file).parent.mkdir(parents=True, exist_ok=True)
        outputs.append(logging.FileHandler(file, encoding="utf-8"))
    for out in outputs:
        out.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        log.addHandler(out)
    log.propagate = False
    return log
