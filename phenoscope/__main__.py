from phenoscope.plans.experiment import main

main()
