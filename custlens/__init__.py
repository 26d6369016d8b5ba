"""custlens: customer analytics over retail invoice lines, on Spark DataFrames and MLlib."""
