import sys

from stellate.cli import main

sys.exit(main())
