from refpanel.plans.benchmark import benchmark_reads, run_benchmark, search_reads
from refpanel.plans.release import Release, build_release
from refpanel.plans.validation import validate_genome

__all__ = ["Release", "benchmark_reads", "build_release", "run_benchmark", "search_reads", "validate_genome"]
