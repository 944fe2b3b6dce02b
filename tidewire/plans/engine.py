"""Starting, stopping and asking: the control surface around a repeated job."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable


class Engine:
    """Runs ``job`` every ``seconds`` until stopped; a stop takes effect between runs."""

    def __init__(self, job: Callable[[], object], seconds: float = 60.0):
        self.job, self.seconds = job, seconds
        self.enabled, self.running = True, False
        self.runs, self.last_error, self.last_seconds = 0, None, None
        self._thread: threading.Thread | None = None
        self._wake = threading.Event()

    def run_once(self) -> None:
        """One run, if enabled; an error is kept and does not end the loop."""
        if not self.enabled:
            return
        self.running, began = True, time.monotonic()
        try:
            self.job()
            self.last_error = None
        except Exception as e:
            self.last_error = e
        finally:
            self.running, self.runs, self.last_seconds = False, self.runs + 1, time.monotonic() - began

    def _loop(self) -> None:
        while not self._wake.wait(self.seconds if self.runs else 0):
            self.run_once()

    def start(self) -> None:
        self.enabled = True
        if self._thread is None or not self._thread.is_alive():
            self._wake.clear()
            self._thread = threading.Thread(target=self._loop, daemon=True)
            self._thread.start()

    def stop(self) -> None:
        self.enabled = False

    def close(self) -> None:
        self.stop()
        self._wake.set()
        if self._thread:
            self._thread.join()

    def status(self) -> dict:
        return {"enabled": self.enabled, "running": self.running, "runs": self.runs, "last_seconds": self.last_seconds, "last_error": None if self.last_error is None else str(self.last_error)}
