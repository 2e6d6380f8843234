"""Starts the batch jobs: spark-submit --py-files skylag.zip bin/batch.py all …"""

from skylag.plans.batch import main

main()
