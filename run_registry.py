"""Launcher for spark-submit: ``spark-submit --py-files strata.zip run_registry.py <stage> ...``."""

from strata.jobs import main

if __name__ == "__main__":
    main()
