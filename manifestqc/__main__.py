import sys

from manifestqc.cli import main

sys.exit(main())
