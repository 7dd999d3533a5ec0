"""Entry script for spark-submit; see ``wattfolio.jobs``."""

from wattfolio.jobs import main

if __name__ == "__main__":
    main()
