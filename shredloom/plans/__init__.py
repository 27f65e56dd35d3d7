"""End-to-end jobs: build, resume, update, extract."""
