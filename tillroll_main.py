"""spark-submit entry point: ``spark-submit tillroll_main.py <stage> ...``."""

import os
import sys

# the package sits next to this file; importable whatever the working directory
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.cli import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
