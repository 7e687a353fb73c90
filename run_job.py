"""spark-submit launcher for the recoflow jobs.

    zip -r recoflow.zip recoflow
    spark-submit --py-files recoflow.zip run_job.py prepare --reviews ... --out ...

Locally: ``python -m recoflow.jobs.cli <subcommand> ...``.
"""

import sys

from recoflow.jobs.cli import main

if __name__ == "__main__":
    sys.exit(main())
