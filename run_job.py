"""Launcher for ``spark-submit``: ``spark-submit --py-files blotter.zip run_job.py <job> ...``
(or ``python run_job.py <job> ...`` in a local checkout).  See ``blotter/jobs.py``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blotter.jobs import main  # noqa: E402

if __name__ == "__main__":
    main()
