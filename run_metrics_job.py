"""Entry of the streaming metrics job for spark-submit: ``run_metrics_job.py --help``."""

from __future__ import annotations

import logging
import sys

from pulse.streaming.job import main

if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
