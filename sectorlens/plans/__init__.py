"""The stored models and the jobs that fill them."""
