"""The domain's tables, each as one plan over its inputs."""
