import sys

from billing_guard.cli import main

sys.exit(main())
