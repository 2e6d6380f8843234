"""Starts the streaming jobs: spark-submit --py-files skylag.zip bin/live.py publish weather …"""

from skylag.plans.live import main

main()
