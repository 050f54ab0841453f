import sys

from tillroll.cli import main

sys.exit(main())
