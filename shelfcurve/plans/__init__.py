"""The composite jobs: elasticity, baseline sales, load and publish."""
