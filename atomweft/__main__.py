import sys

from atomweft.cli import main

sys.exit(main())
